"""Profiling aggregates and chart data (AGG1-AGG20, CHD1, CHD2, CHD8, OUT6 helpers).

Rule: every statistic over k columns is one ``agg`` (one scan, map-side
partial aggregation); long/tidy output is produced from that single result
row or from a ``groupBy`` whose groups are bounded (years, segments, bins).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import numeric_columns, small_frame
from .quantiles import grouped_quantiles, quantiles


def long_by_feature(df: DataFrame, columns: Sequence[str], stats: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One aggregate of ``len(columns) x len(stats)`` expressions, reshaped to one row per feature.

    The reshape (``stack``) runs on the single aggregated row, never on data rows.
    """
    aggs = [fn(F.col(c)).alias(f"{s}__{i}") for i, c in enumerate(columns) for s, fn in stats.items()]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{s}__{i}").alias(s) for s in stats])
               for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AGG6: count, mean, std (sample), min, 25%, 50%, 75%, max per column.

    Moments and extremes come from one aggregate, quartiles from :func:`quantiles.quantiles`.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                 F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}")]
    r = df.agg(*aggs).first()
    qs = quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, r[f"n{i}"], r[f"m{i}"], r[f"s{i}"], r[f"lo{i}"], *qs[c], r[f"hi{i}"]) for i, c in enumerate(cols)]
    return small_frame(df.sparkSession, rows, "feature string, count long, mean double, std double, min double, "
                                              "q25 double, q50 double, q75 double, max double")


def missingness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """AGG7: per column (and group) missing count and percent."""
    stats = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        stats += [F.sum(F.col(c).isNull().cast("long")).alias(f"m{i}")]
    agg = (df.groupBy(*by) if by else df).agg(*stats)
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(columns)]
    return (agg.select(*by, "n_rows", F.explode(F.array(*structs)).alias("r"))
            .select(*by, "r.feature", "n_rows", "r.n_missing")
            .withColumn("pct_missing", F.col("n_missing") * 100.0 / F.col("n_rows")))


def average_missingness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """AGG8: mean over columns of the missing share, x100 (overall or by group)."""
    share = sum((F.avg(F.col(c).isNull().cast("double")) for c in columns), F.lit(0.0)) / F.lit(len(columns))
    return (df.groupBy(*by) if by else df).agg((share * 100.0).alias("avg_missing_pct"))


def group_summary(df: DataFrame, by: Sequence[str], value: str, z: float = 1.96) -> DataFrame:
    """AGG3: n, mean, sd, se and a normal CI of the mean per group."""
    out = df.groupBy(*by).agg(F.count(F.col(value)).alias("n"), F.avg(value).alias("mean"),
                              F.stddev_samp(value).alias("sd"))
    se = F.col("sd") / F.sqrt(F.col("n"))
    return out.withColumn("se", se).withColumn("ci_low", F.col("mean") - z * se).withColumn("ci_high", F.col("mean") + z * se)


def group_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """AGG4: n, mean, sd, median, max per group; rows without a group are a group of their own, with no median."""
    moments = df.groupBy(by).agg(F.count(F.col(value)).alias("n"), F.avg(value).alias("mean"),
                                 F.stddev_samp(value).alias("sd"), F.max(value).cast("double").alias("max"))
    medians = grouped_quantiles(df, [value], [0.5], by).withColumnRenamed("q0_0", "median")
    return moments.join(medians, by, "left")


def yearly_trend(df: DataFrame, time: str, value: str) -> DataFrame:
    """AGG5: slope/intercept of the yearly means over time and the endpoint delta."""
    means = df.groupBy(time).agg(F.avg(value).alias("m"))
    return means.agg(F.regr_slope("m", F.col(time).cast("double")).alias("slope"),
                     F.regr_intercept("m", F.col(time).cast("double")).alias("intercept"),
                     (F.max_by("m", time) - F.min_by("m", time)).alias("delta"),
                     F.count(F.lit(1)).alias("n_periods"))


def range_summary(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """AGG10 piece: min, median, p99, max per column with an edition label."""
    aggs = [f(F.col(c)).cast("double").alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    r = df.agg(*aggs).first()
    qs = quantiles(df, columns, [0.5, 0.99])
    rows = [(c, r[f"lo{i}"], *qs[c], r[f"hi{i}"], label) for i, c in enumerate(columns)]
    return small_frame(df.sparkSession, rows, "feature string, min double, median double, p99 double, max double, edition string")


def tail_shares(df: DataFrame, column: str, upper: float, lower: float) -> DataFrame:
    """AGG11: share above/below bounds, p1, p99, max."""
    c = F.col(column)
    p01, p99 = quantiles(df, [column], [0.01, 0.99])[column]
    return df.agg(F.avg((c > upper).cast("double")).alias("share_above"), F.avg((c < lower).cast("double")).alias("share_below"),
                  F.lit(p01).cast("double").alias("p01"), F.lit(p99).cast("double").alias("p99"), F.max(c).cast("double").alias("max"))


def distinct_counts(df: DataFrame, columns: Sequence[str], time: str | None = None, approx_rsd: float | None = None):
    """AGG12/AGG13: distinct counts (exact or HyperLogLog) and time bounds."""
    cnt = (lambda c: F.approx_count_distinct(c, approx_rsd)) if approx_rsd else F.countDistinct
    aggs = [cnt(F.col(c)).alias(f"n_{c}") for c in columns]
    if time:
        aggs += [F.min(time).alias("time_min"), F.max(time).alias("time_max")]
    return df.agg(*aggs)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """AGG15: n, Pearson, OLS slope/intercept (b on a), bias, MAE, median/p95/max abs error."""
    pair = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    err = F.col(b) - F.col(a)
    median, p95 = quantiles(pair.select(F.abs(err).alias("err")), ["err"], [0.5, 0.95])["err"]
    return pair.agg(F.count(F.lit(1)).alias("n"), F.corr(a, b).alias("pearson"),
                    F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"),
                    F.avg(err).alias("bias"), F.avg(F.abs(err)).alias("mae"),
                    F.lit(median).cast("double").alias("median_abs_err"), F.lit(p95).cast("double").alias("p95_abs_err"),
                    F.max(F.abs(err)).alias("max_abs_err"))


def value_sets(df: DataFrame, by: Sequence[str], column: str, flag: str) -> DataFrame:
    """AGG16: sorted distinct values of a low-cardinality column per group plus a share."""
    return df.groupBy(*by).agg(F.sort_array(F.collect_set(column)).alias("values"),
                               F.avg(F.col(flag).cast("double")).alias("share"))


def set_fingerprint(key: str | Column) -> Column:
    """Order-free fingerprint of a set: sum of 60-bit md5 prefixes (SQL-reproducible)."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.conv(F.substring(F.md5(k), 1, 15), 16, 10).cast("decimal(38,0)")


def modal_entity_set(df: DataFrame, time: str, entity: str) -> DataFrame:
    """AGG17: which set of entities occurs in most periods.

    Each period's set is summarised by (size, sum of md5 fingerprints) with
    an aggregate, so no set is ever materialised in one row.
    """
    per = (df.select(time, entity).distinct()
           .groupBy(time).agg(F.count(F.lit(1)).alias("set_size"), F.sum(set_fingerprint(entity)).alias("fp")))
    return (per.groupBy("set_size", "fp").agg(F.count(F.lit(1)).alias("n_periods"), F.min(time).alias("first_period"))
            .orderBy(F.desc("n_periods"), "first_period").limit(1).drop("fp"))


def equal_width_bins(df: DataFrame, x: str, bins: int, value: str | None = None) -> DataFrame:
    """AGG18: right-closed equal-width bins over [min, max] (lowest value in bin 1)."""
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    width = (hi - lo) / bins if hi is not None and hi > lo else 1.0
    b = F.least(F.greatest(F.ceil((F.col(x) - F.lit(lo)) / F.lit(width)), F.lit(1)), F.lit(bins)).cast("int")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean_x")]
    if value:
        aggs.append(F.avg(value).alias("mean_value"))
    return df.filter(F.col(x).isNotNull()).groupBy(b.alias("bin")).agg(*aggs)


def quantile_edges(df: DataFrame, x: str, q: int) -> list[float]:
    edges = quantiles(df, [x], [i / q for i in range(q + 1)])[x]
    return sorted(set(float(e) for e in edges if e is not None))


def quantile_bin_expr(x: str | Column, edges: Sequence[float]) -> Column:
    """Right-closed bin of ``x`` over distinct edges (lowest edge clamped into bin 1)."""
    col = F.col(x) if isinstance(x, str) else x
    arr = F.array(*[F.lit(float(e)) for e in edges])
    return F.greatest(F.size(F.filter(arr, lambda e: e < col)), F.lit(1)).cast("int")


def quantile_bins(df: DataFrame, x: str, q: int, value: str | None = None) -> DataFrame:
    """AGG19: qcut-style bins from exact quantile edges; fewer than 3 edges -> no bins."""
    edges = quantile_edges(df, x, q)
    if len(edges) < 3:
        return df.sparkSession.createDataFrame([], "bin int, n long, mean_x double, mean_value double")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean_x")]
    if value:
        aggs.append(F.avg(value).alias("mean_value"))
    return df.filter(F.col(x).isNotNull()).groupBy(quantile_bin_expr(x, edges).alias("bin")).agg(*aggs)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """CHD1: per-column histogram counts, numpy convention (last bin right-closed).

    Ranges come from one aggregate; counting is one ``groupBy(feature, bin)``
    over an exploded (feature, value) stream with map-side partial counts.
    """
    rng = df.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
                 *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)]).first()
    structs = []
    for i, c in enumerate(columns):
        lo, hi = rng[f"lo{i}"], rng[f"hi{i}"]
        if lo is None:
            continue
        width = (hi - lo) / bins if hi > lo else 1.0
        b = F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        structs.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("feature"), b.alias("bin"),
                                                            (F.lit(lo) + b * F.lit(width)).alias("left"))))
    long = df.select(F.explode(F.array(*structs)).alias("r")).filter(F.col("r").isNotNull()).select("r.*")
    return long.groupBy("feature", "bin", "left").agg(F.count(F.lit(1)).alias("count"))


def box_stats(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """CHD2: quartiles, whiskers (extreme values inside the fences) and flier counts.

    Quartiles first, then one scan for whiskers/fliers against literal fences.
    """
    qs = quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs, fences = [], {}
    for i, c in enumerate(columns):
        q1, med, q3 = qs[c]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        fences[c] = (q1, med, q3, lo, hi)
        col = F.col(c)
        inside = (col >= lo) & (col <= hi)
        aggs += [F.min(F.when(inside, col)).alias(f"wl{i}"), F.max(F.when(inside, col)).alias(f"wh{i}"),
                 F.sum((~inside).cast("long")).alias(f"nf{i}")]
    r = df.agg(*aggs).first()
    rows = [(c, *fences[c][:3], r[f"wl{i}"], r[f"wh{i}"], r[f"nf{i}"]) for i, c in enumerate(columns)]
    return small_frame(df.sparkSession, rows, "feature string, q1 double, median double, q3 double, "
                                              "whisker_low double, whisker_high double, n_fliers long")


def aggregate_by_entity(df: DataFrame, entity: str, time: str, numeric_fn: Callable[[Column], Column] = F.avg,
                        numeric: Sequence[str] | None = None) -> DataFrame:
    """AGG1: numeric -> ``numeric_fn`` (default mean), others -> earliest non-null by time."""
    nums = list(numeric) if numeric is not None else numeric_columns(df, (entity, time))
    others = [c for c in df.columns if c not in nums and c not in (entity, time)]
    return df.groupBy(entity).agg(
        *[numeric_fn(F.col(c)).alias(c) for c in nums],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time))).alias(c) for c in others])


def missing_compare(a: DataFrame, b: DataFrame, label_a: str = "a", label_b: str = "b") -> DataFrame:
    """AGG9: missing percent per shared numeric column in two editions, with the delta."""
    shared = [c for c in numeric_columns(a) if c in set(numeric_columns(b))]
    ma = missingness(a, shared).select("feature", F.col("pct_missing").alias(f"pct_missing_{label_a}"))
    mb = missingness(b, shared).select("feature", F.col("pct_missing").alias(f"pct_missing_{label_b}"))
    return ma.join(mb, "feature").withColumn(
        "delta", F.col(f"pct_missing_{label_b}") - F.col(f"pct_missing_{label_a}"))


def coverage(df: DataFrame, entity: str, code: str, value: str, sentinel: float = 0.0) -> DataFrame:
    """AGG14: rows, entities, share of rows with a code, sentinel count (one aggregate).

    The unmapped entities themselves are a DataFrame (:func:`unmapped`), never a list.
    """
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(entity).alias("n_entities"),
                  F.avg(F.col(code).isNotNull().cast("double")).alias("mapped_share"),
                  F.sum((F.col(value) == F.lit(sentinel)).cast("long")).alias("n_sentinel"))


def unmapped(df: DataFrame, entity: str, code: str) -> DataFrame:
    return df.filter(F.col(code).isNull()).select(entity).distinct()
