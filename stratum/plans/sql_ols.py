"""Least squares in SQL, for oracles: the swept cross products of every subset of some predictors.

One CTE holds the centred sums of products; each subset's CTE sweeps one more
predictor out of its parent's.  After sweeping a set, ``s_i_y`` are its
coefficients, ``-s_i_i`` the diagonal of the inverse and ``s_y_y`` its residual
sum of squares.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement


def _cell(a: int, b: int) -> str:
    return f"s_{min(a, b)}_{max(a, b)}"


def moments_sql(source: str, xs: Sequence[str], y: str, name: str = "e0") -> str:
    """CTEs ``{name}_m`` (n, means ``m_i``; the target last) and ``{name}`` (centred sums over complete rows)."""
    cols = [*xs, y]
    full = " AND ".join(f"({c}) IS NOT NULL" for c in cols)
    values = ", ".join(f"CAST({c} AS DOUBLE) AS v{i}" for i, c in enumerate(cols))
    means = ", ".join(f"fsum(v{i}) / count(*) AS m_{i}" for i in range(len(cols)))
    sums = ", ".join(f"fsum((v{a} - m_{a}) * (v{b} - m_{b})) AS {_cell(a, b)}" for a, b in combinations_with_replacement(range(len(cols)), 2))
    return (f"{name}_v AS (SELECT {values} FROM {source} WHERE {full}), "
            f"{name}_m AS (SELECT CAST(count(*) AS DOUBLE) AS n, {means} FROM {name}_v), "
            f"{name} AS (SELECT {sums} FROM {name}_v, {name}_m)")


def sweep_sql(parent: str, k: int, pivot: int) -> str:
    """``SELECT`` that sweeps column ``pivot`` of ``parent`` (k predictors, target at position k)."""
    out = []
    for a, b in combinations_with_replacement(range(k + 1), 2):
        if a == b == pivot:
            e = f"-1.0 / {_cell(a, b)}"
        elif pivot in (a, b):
            e = f"{_cell(a, b)} / {_cell(pivot, pivot)}"
        else:
            e = f"{_cell(a, b)} - {_cell(a, pivot)} * {_cell(b, pivot)} / {_cell(pivot, pivot)}"
        out.append(f"{e} AS {_cell(a, b)}")
    return f"SELECT {', '.join(out)} FROM {parent}"


def subsets_sql(k: int, base: str = "e0") -> str:
    """CTEs ``e{mask}`` of every non-empty subset; each is its parent's with its highest predictor swept."""
    parts = []
    for mask in range(1, 1 << k):
        top = mask.bit_length() - 1
        rest = mask ^ (1 << top)
        parts.append(f"e{mask} AS ({sweep_sql(f'e{rest}' if rest else base, k, top)})")
    return ", ".join(parts)


def selection_sql(source: str, xs: Sequence[str], y: str, starts: Sequence[tuple[str, str, float]], best_only: bool, digits: int) -> str:
    """The rows of selection paths ``(direction, criterion, threshold)`` with no base terms."""
    k = len(xs)
    sub = " UNION ALL ".join(f"SELECT {m} AS mask, {m.bit_count()} AS terms, {_cell(k, k)} AS rss FROM e{m}" for m in range(1 << k))
    first = " UNION ALL ".join(f"SELECT '{d}' AS direction, '{c}' AS criterion, {t!r} AS th, {(1 << k) - 1 if d == 'backward' else 0} AS mask"
                               for d, c, t in starts)
    names = "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    r = lambda e: f"round({e}, {digits}) + 0.0"
    return f"""
WITH RECURSIVE {moments_sql(source, xs, y)}, {subsets_sql(k)},
sub AS (SELECT *, terms + 1 AS p, n FROM ({sub}), e0_m),
whole AS (SELECT {_cell(k, k)} AS tss FROM e0),
full_ AS (SELECT rss / (n - p) AS s2 FROM sub WHERE mask = {(1 << k) - 1}),
dev AS (SELECT sub.*, n * (ln(2 * pi()) + ln(rss / n) + 1) AS d, 1 - (n - 1) / (n - p) * rss / tss AS adj_r2, rss / s2 + 2 * p - n AS cp
        FROM sub, whole, full_),
met AS (SELECT *, d + 2 * p AS aic, d + 2 * p + 2.0 * p * (p + 1) / (n - p - 1) AS aicc, d + p * ln(n) AS bic,
               d / 2 + 0.5 * p * ln(n) AS mdl, sqrt(rss / n) AS rmse FROM dev),
crit AS (SELECT mask, unnest(['aic', 'aicc', 'bic', 'mdl', 'cp', 'adj_r2']) AS criterion,
                unnest([aic, aicc, bic, mdl, cp, -adj_r2]) AS v FROM met),
path AS (
  SELECT direction, f.criterion, th, 0 AS step, f.mask, v,
         CASE WHEN f.mask = 0 THEN CAST([] AS INTEGER[]) ELSE CAST(range({k}) AS INTEGER[]) END AS entered
  FROM ({first}) f JOIN crit c ON c.mask = f.mask AND c.criterion = f.criterion
  UNION ALL
  SELECT direction, criterion, th, step + 1, nm, nv,
         CASE WHEN nm > mask THEN list_append(entered, CAST(log2(xor(nm, mask)) AS INTEGER))
              ELSE list_filter(entered, lambda i: i <> CAST(log2(xor(nm, mask)) AS INTEGER)) END
  FROM (SELECT p.direction, p.criterion, p.th, p.step, p.mask, p.v, p.entered, arg_min(c.mask, c.v) AS nm, min(c.v) AS nv
        FROM path p JOIN crit c ON c.criterion = p.criterion AND bit_count(xor(c.mask, p.mask)) = 1
             AND (p.direction <> 'forward' OR c.mask > p.mask) AND (p.direction <> 'backward' OR c.mask < p.mask)
        GROUP BY ALL) m WHERE nv < v - th),
ranked AS (SELECT *, row_number() OVER (PARTITION BY direction, criterion ORDER BY v, step) = 1 AS is_best FROM path)
SELECT direction || '_' || criterion AS label, direction, criterion, step, CAST(terms AS INTEGER) AS n_terms,
       CASE WHEN len(entered) = 0 THEN '1' ELSE array_to_string(list_transform(entered, lambda i: {names}[i + 1]), ' + ') END AS rhs,
       {r("aic")} AS aic, {r("aicc")} AS aicc, {r("bic")} AS bic, {r("mdl")} AS mdl, {r("adj_r2")} AS adj_r2, {r("rmse")} AS rmse,
       CAST(NULL AS DOUBLE) AS cv_rmse, {r("cp")} AS cp, is_best
FROM ranked JOIN met USING (mask){' WHERE is_best' if best_only else ''}"""
