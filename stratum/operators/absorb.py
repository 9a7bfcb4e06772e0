"""Linear fits with categories of any number of levels (FN4, OLS9).

A category is absorbed instead of becoming a dummy a level: target and terms are
replaced by their deviations from its levels' means, which leaves the other
coefficients, the residuals and, with the levels taken off the degrees of
freedom, the standard errors of the dummy-variable fit.  Levels stay in
DataFrames: none passes through the driver or the plan.

With two categories the deviations are found by alternating sweeps.  A sweep
works on the table of level pairs (count and sums, one aggregate of the rows),
not on the rows: the means of one category follow from the pairs less the
effects of the other.  Sweeps end when no effect moves by more than ``tol`` of
its column's spread.  The degrees of freedom are the levels of both less the
number of connected parts of the table of pairs.

Rows with a NULL in the target, a term or a category are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .gram import gram
from .ols import OLSModel, Y, design_frame, model_from_gram
from .terms import Term, check_columns, expand

TOL = 1e-11
MAX_SWEEPS = 500


def _effects(pairs: DataFrame, columns: Sequence[str], a: str, b: str, other: DataFrame | None) -> DataFrame:
    """Means of category ``a`` over the pairs, less the effects ``other`` of category ``b``."""
    if other is not None:
        pairs = pairs.join(other.withColumnsRenamed({c: f"o_{c}" for c in columns}).withColumnRenamed(b, "_other"), F.col(b) == F.col("_other"))
    sums = [F.sum(F.col(c) - (F.col("n") * F.col(f"o_{c}") if other is not None else F.lit(0.0))) / F.sum("n") for c in columns]
    return pairs.groupBy(a).agg(*[s.alias(c) for s, c in zip(sums, columns)])


def parts(pairs: DataFrame, a: str, b: str) -> int:
    """Connected parts of a table of level pairs: the least level of ``a`` spreads over shared levels until nothing changes."""
    links = checkpointed(pairs.select(F.col(a).alias("l_a"), F.col(b).alias("l_b")).distinct())
    label = checkpointed(links.groupBy("l_a").agg(F.min(F.col("l_a")).alias("part")))
    while True:
        by_b = links.join(label, "l_a").groupBy("l_b").agg(F.min("part").alias("part"))
        new = checkpointed(links.join(by_b, "l_b").groupBy("l_a").agg(F.min("part").alias("new")))
        if not new.join(label, "l_a").where("new <> part").limit(1).count():
            return new.select("new").distinct().count()
        label = new.withColumnRenamed("new", "part")


def deviations(rows: DataFrame, columns: Sequence[str], absorb: Sequence[str], tol: float = TOL, max_sweeps: int = MAX_SWEEPS) -> tuple[DataFrame, int]:
    """``rows`` with ``columns`` as deviations from the levels of one or two categories, and the degrees of freedom these take."""
    if len(absorb) == 1:
        a = absorb[0]
        means = rows.groupBy(F.col(a).alias("_level")).agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(columns)])
        out = rows.join(means, F.col(a) == F.col("_level")).withColumns({c: F.col(c) - F.col(f"_m{i}") for i, c in enumerate(columns)})
        return out.select(*rows.columns), means.count()
    a, b = absorb
    spread = rows.agg(*[F.stddev_pop(c).alias(c) for c in columns]).first()
    pairs = checkpointed(rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in columns]))
    of_a, of_b = checkpointed(_effects(pairs, columns, a, b, None)), None
    for _ in range(max_sweeps):
        new_b = checkpointed(_effects(pairs, columns, b, a, of_a))
        new_a = checkpointed(_effects(pairs, columns, a, b, new_b))
        moves = new_a.join(of_a.withColumnsRenamed({c: f"o_{c}" for c in columns}), a).agg(
            *[F.max(F.abs(F.col(c) - F.col(f"o_{c}"))).alias(c) for c in columns]).first()
        of_a, of_b = new_a, new_b
        if all((moves[c] or 0.0) <= tol * (spread[c] or 1.0) for c in columns):
            break
    out = rows
    for name, effects in ((a, of_a), (b, of_b)):
        effects = effects.withColumnsRenamed({c: f"_e_{c}" for c in columns}).withColumnRenamed(name, "_level")
        out = out.join(effects, F.col(name) == F.col("_level")).withColumns({c: F.col(c) - F.col(f"_e_{c}") for c in columns}).select(*rows.columns)
    return out, of_a.count() + of_b.count() - parts(pairs, a, b)


def fit_absorbed(df: DataFrame, target: str, terms: Sequence[str | Term], absorb: str | Sequence[str], tol: float = TOL) -> OLSModel:
    """OLS of ``target`` on ``terms`` and all levels of one or two categories."""
    names = [absorb] if isinstance(absorb, str) else list(absorb)
    if not 1 <= len(names) <= 2:
        raise ValueError("one or two categories can be absorbed")
    ts = expand(terms, df)
    check_columns(df, ts, target)
    levels = [f"_c{i}" for i in range(len(names))]
    columns = [*[f"_t{i}" for i in range(len(ts))], Y]
    rows = design_frame(df, target, ts, [F.col(c).alias(n) for c, n in zip(names, levels)]).dropna()
    rows = rows.where(" AND ".join(f"NOT isnan({c})" for c in columns))
    within, taken = deviations(checkpointed(rows), columns, levels, tol)
    g = gram(within, columns)
    if g.n <= 0:
        raise ValueError("no complete rows to fit")
    return model_from_gram(g, target, ts, intercept=False, absorbed=taken)
