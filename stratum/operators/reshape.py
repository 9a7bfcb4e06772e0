"""Reshaping and joins (RSH1-RSH3, JOI1-JOI8, SET1, SET2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

YEAR_SUFFIX = r"^(.*)_(\d{4})$"


def wide_to_long(df: DataFrame, ids: Sequence[str], value_name: str = "value", series_name: str = "series",
                 positive_only: bool = False, years: Sequence[int] | None = None) -> DataFrame:
    """RSH1: melt ``<prefix>_<YYYY>`` columns into (ids, series, year, value).

    Exact suffix match (R21): ``hdi_f_2010`` is series ``hdi_f``, never
    shadowed by ``hdi``.  Year pruning happens on the column list, so
    unwanted columns never leave the scan.
    """
    import re

    pat = re.compile(YEAR_SUFFIX)
    wanted = [c for c in df.columns if c not in ids and pat.match(c)
              and (years is None or int(pat.match(c).group(2)) in set(years))]
    long = df.select(*ids, *wanted).unpivot(list(ids), wanted, "_col", value_name)
    out = long.select(*ids, F.regexp_extract("_col", YEAR_SUFFIX, 1).alias(series_name),
                      F.regexp_extract("_col", YEAR_SUFFIX, 2).cast("int").alias("year"),
                      F.col(value_name).cast("double").alias(value_name))
    if positive_only:
        out = out.withColumn(value_name, F.when(F.col(value_name) > 0, F.col(value_name)))
    return out


def long_to_wide(df: DataFrame, ids: Sequence[str], series: str, value: str, levels: Sequence[str]) -> DataFrame:
    """RSH3/JOI4: one ``groupBy(ids).pivot(series, levels)`` instead of a chain of outer joins."""
    return df.groupBy(*ids).pivot(series, list(levels)).agg(F.first(value, ignorenulls=True))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "feature", val: str = "value") -> DataFrame:
    """RSH2."""
    return df.unpivot(list(ids), list(values), var, val)


def enrich_codes(df: DataFrame, name_col: str, dim: DataFrame, dim_name: str, dim_code: str,
                 code_col: str = "code", overrides: Mapping[str, str] | None = None,
                 overwrite: bool = False) -> DataFrame:
    """JOI1: name -> code via a dimension join, misses filled from an override map.

    Skipped when ``code_col`` exists and ``overwrite`` is False.  A name that the
    dimension gives several codes gets the least of them.
    """
    if code_col in df.columns and not overwrite:
        return df
    base = df.drop(code_col) if code_col in df.columns else df
    lookup = dim.select(F.col(dim_name).alias("_name"), F.col(dim_code).alias("_code")).groupBy("_name").agg(F.min("_code").alias("_code"))
    joined = base.join(lookup, base[name_col] == lookup["_name"], "left")
    fallback = F.lit(None).cast("string")
    if overrides:
        m = F.create_map(*[x for kv in sorted(overrides.items()) for x in (F.lit(kv[0]), F.lit(kv[1]))])
        fallback = m[F.col(name_col)]
    return joined.withColumn(code_col, F.coalesce(F.col("_code").cast("string"), fallback)).drop("_name", "_code")


def merge_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """JOI2/JOI3: equi-join on (code, year); missing keys are dropped first (R4).

    Left rows with a missing key survive a left join with NULL right columns.
    """
    keys = list(keys)
    r = right.dropna(subset=keys)
    if how == "inner":
        return left.dropna(subset=keys).join(r, keys, "inner")
    return left.join(r, keys, how)


def backfill(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """JOI6: ``coalesce(primary, fallback)`` for each (primary -> fallback) pair."""
    return df.withColumns({a: F.coalesce(F.col(a), F.col(b)) for a, b in pairs.items()})


def missing_before_after(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """JOI6 report: missing counts per column before and after a backfill (two one-row aggregates)."""
    b = before.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    a = after.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    sb = b.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("missing_before"))
                                      for c in columns])).alias("r")).select("r.*")
    sa = a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("missing_after"))
                                      for c in columns])).alias("r")).select("r.*")
    return sb.join(sa, "feature")


def entities_only_in(a: DataFrame, b: DataFrame, entity: str) -> DataFrame:
    """SET2/JOI8: entities in ``a`` that never occur in ``b`` (anti join)."""
    return a.select(entity).distinct().join(b.select(entity), entity, "left_anti")


def entities_in_both(a: DataFrame, b: DataFrame, entity: str) -> DataFrame:
    return a.select(entity).distinct().join(b.select(entity), entity, "left_semi")


def label_union(frames: Mapping[str, DataFrame], label: str = "source") -> DataFrame:
    """SET1: row concat with a label, columns aligned by name."""
    out = None
    for k, f in frames.items():
        f = f.withColumn(label, F.lit(k))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def attach_attributes(df: DataFrame, attributes: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """JOI5: deduplicate per-entity attributes (first under ``order_by``) and left-join them."""
    from .clean import dedup_first

    dim = dedup_first(attributes, [key], order_by)
    return df.join(dim, key, "left")
