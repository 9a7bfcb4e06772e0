"""Model terms as Column expressions (FN4, FN5, FN7; OLS1/OLS5 term expansion).

A term spec is one of ``a``, ``a:b``, ``a*b`` (expands to a, b, a:b),
``I(a^n)``, ``C(a)`` (treatment dummies, first level dropped) and
``bs(a, df=k[, degree=d][, lower_bound=x][, upper_bound=y])`` (B-spline basis).  Data-dependent pieces (dummy
levels, spline knots) are computed once from the training frame and stored
in the term, so prediction on new rows or another period reuses them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Term:
    name: str
    expr: Column
    source: tuple[str, ...] = ()

    def __repr__(self) -> str:  # Column reprs are noisy
        return f"Term({self.name!r})"


_POW = re.compile(r"^I\(\s*(\w+)\s*\^\s*(\d+)\s*\)$")
_CAT = re.compile(r"^C\(\s*(\w+)\s*\)$")
_NUMBER = r"([-+]?[\d.]+(?:[eE][-+]?\d+)?)"
_BS = re.compile(r"^bs\(\s*(\w+)\s*(?:,\s*df\s*=\s*(\d+))?\s*(?:,\s*degree\s*=\s*(\d+))?"
                 rf"\s*(?:,\s*lower_bound\s*=\s*{_NUMBER})?\s*(?:,\s*upper_bound\s*=\s*{_NUMBER})?\s*\)$")


def bspline_basis(x: Column, knots: Sequence[float], degree: int, lo: float, hi: float) -> list[Column]:
    """Cox-de Boor recursion as Column expressions; intercept column dropped.

    A value outside [lo, hi] is an error: give bounds that cover the data to be scored.
    """
    t = [lo] * (degree + 1) + list(knots) + [hi] * (degree + 1)
    n_basis = len(t) - degree - 1
    inside = (x >= F.lit(lo)) & (x <= F.lit(hi))

    def b0(i: int) -> Column:
        if t[i + 1] == hi and t[i] < hi:
            cond = (x >= F.lit(t[i])) & (x <= F.lit(t[i + 1]))  # last non-empty span is closed
        else:
            cond = (x >= F.lit(t[i])) & (x < F.lit(t[i + 1]))
        return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))

    level = [b0(i) for i in range(len(t) - 1)]
    for p in range(1, degree + 1):
        nxt = []
        for i in range(len(t) - p - 1):
            left = right = F.lit(0.0)
            if t[i + p] != t[i]:
                left = (x - F.lit(t[i])) / F.lit(t[i + p] - t[i]) * level[i]
            if t[i + p + 1] != t[i + 1]:
                right = (F.lit(t[i + p + 1]) - x) / F.lit(t[i + p + 1] - t[i + 1]) * level[i + 1]
            nxt.append(left + right)
        level = nxt
    beyond = F.raise_error(F.concat(F.lit(f"outside the spline bounds [{lo}, {hi}]: "), x.cast("string"))).cast("double")
    return [F.when(inside, level[i]).when(x.isNotNull() & ~F.isnan(x), beyond) for i in range(1, n_basis)]


def expand(specs: Sequence[str | Term], df: DataFrame | None = None) -> list[Term]:
    """Turn term specs into Terms; ``C()`` and ``bs()`` read levels/knots from ``df``."""
    out: list[Term] = []
    for s in specs:
        if isinstance(s, Term):
            out.append(s)
            continue
        s = s.strip()
        if m := _POW.match(s):
            a, n = m.group(1), int(m.group(2))
            out.append(Term(s, F.pow(F.col(a).cast("double"), F.lit(float(n))), (a,)))
        elif m := _CAT.match(s):
            a = m.group(1)
            if df is None:
                raise ValueError("C() terms need the training frame for their levels")
            levels = [r[0] for r in df.select(a).distinct().dropna().orderBy(a).collect()]  # categorical levels
            # a level that the training frame lacks has no coefficient: NULL, so the row is not scored as the first level
            known = F.col(a).isin(levels)
            out += [Term(f"C({a})[T.{v}]", F.when(known, (F.col(a) == F.lit(v)).cast("double")), (a,)) for v in levels[1:]]
        elif m := _BS.match(s):
            a, k, deg = m.group(1), int(m.group(2) or 4), int(m.group(3) or 3)
            if df is None:
                raise ValueError("bs() terms need the training frame for their knots")
            n_inner = k - deg
            probs = [(i + 1) / (n_inner + 1) for i in range(n_inner)]
            from .quantiles import quantiles

            qs = quantiles(df, [a], [0.0, *probs, 1.0])[a]
            lo = float(m.group(4)) if m.group(4) else float(qs[0])
            hi = float(m.group(5)) if m.group(5) else float(qs[-1])
            knots = list(qs[1:-1])
            basis = bspline_basis(F.col(a).cast("double"), knots, deg, lo, hi)
            out += [Term(f"{a}_bs{j + 1}", e, (a,)) for j, e in enumerate(basis)]
        elif "*" in s:
            a, b = [p.strip() for p in s.split("*", 1)]
            out += expand([a, b, f"{a}:{b}"], df)
        elif ":" in s:
            parts = [p.strip() for p in s.split(":")]
            expr = F.col(parts[0]).cast("double")
            for p in parts[1:]:
                expr = expr * F.col(p).cast("double")
            out.append(Term(s, expr, tuple(parts)))
        else:
            out.append(Term(s, F.col(s).cast("double"), (s,)))
    seen, uniq = set(), []
    for t in out:
        if t.name not in seen:
            seen.add(t.name)
            uniq.append(t)
    return uniq


def check_columns(df: DataFrame, terms: Sequence[Term], target: str | None = None) -> None:
    """OLS5: a missing source column is a ``KeyError`` (not a silent NULL)."""
    need = {c for t in terms for c in t.source} | ({target} if target else set())
    missing = sorted(c for c in need if c not in df.columns)
    if missing:
        raise KeyError(f"columns not found: {missing}")
