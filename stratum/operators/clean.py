"""Cleaning: carry-forward, imputation, dedup, filters, per-entity lags
(CLN1-CLN10, FLT1-FLT8, WIN1, WIN2, WIN4).

Per-entity sequential operators (LOCF, lag) are ordered scans over range
partitions (:mod:`scan`): an entity that holds a third of all rows is many
partitions, not one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..frames import numeric_columns
from .scan import filled_forward, previous_row


def carry_forward(df: DataFrame, entity: str, time: str, columns: Sequence[str] | None = None,
                  drop_remaining: bool = False) -> DataFrame:
    """CLN1/WIN1: last observation carried forward per entity in time order."""
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in (entity, time)]
    out = filled_forward(df, entity, time, cols)
    return out.dropna(subset=cols) if drop_remaining else out


def lag_by_entity(df: DataFrame, entity: str, time: str, column: str, name: str | None = None,
                  drop_missing: bool = True) -> DataFrame:
    """WIN2: previous *row's* value per entity (not previous calendar year)."""
    name = name or f"{column}_lag1"
    out = previous_row(df, entity, time, column, name)
    return out.filter(F.col(name).isNotNull()) if drop_missing else out


def fill_values(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def impute(df: DataFrame, columns: Sequence[str], strategy: str = "median", entity: str | None = None,
           time: str | None = None, drop_remaining: bool = False) -> DataFrame:
    """CLN2: ``drop`` | ``median`` | ``mean`` | ``zero`` | ``carry_forward``."""
    from .scale import medians

    cols = list(columns)
    if strategy == "drop":
        return df.dropna(subset=cols)
    if strategy == "median":
        out = fill_values(df, medians(df, cols))
    elif strategy == "mean":
        out = fill_values(df, column_means(df, cols))
    elif strategy == "zero":
        out = df.fillna(0.0, subset=cols)
    elif strategy == "carry_forward":
        if not entity or not time:
            raise ValueError("carry_forward needs entity and time columns")
        out = carry_forward(df, entity, time, cols)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.dropna(subset=cols) if drop_remaining else out


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """CLN7: fill with the most frequent value (smallest value on ties)."""
    top = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
           .orderBy(F.desc("count"), column).first())
    return df if top is None else df.withColumn(column, F.coalesce(F.col(column), F.lit(top[column])))


def drop_all_missing_columns(df: DataFrame) -> DataFrame:
    """CLN8: one aggregate of non-null counts, then drop empty columns."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if counts[c] == 0])


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """CLN9: keep the first row per key under an explicit order.

    ``min_by(struct(row), struct(order..., row))`` is an aggregate with a
    map-side partial step, so a hot key is reduced inside every task before
    the shuffle instead of being sorted in one window partition.  Ties on
    ``order_by`` are broken by the remaining columns.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order, *[F.col(c) for c in rest])).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    """FLT1."""
    return df.filter(F.col(target).isNotNull())


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """FLT2 (``how='any'``)."""
    return df.dropna(how="any", subset=list(columns))


def latest_valid_time(df: DataFrame, time: str, target: str):
    """FLT4: max time over rows whose target is present; error if none."""
    v = df.filter(F.col(target).isNotNull()).agg(F.max(time)).first()[0]
    if v is None:
        raise ValueError(f"no row with a non-missing {target!r}")
    return v


def slice_time(df: DataFrame, time: str, value) -> DataFrame:
    """FLT3: a single time slice or a set of them (partition pruning when partitioned by time)."""
    if isinstance(value, (list, tuple, set)):
        return df.filter(F.col(time).isin(list(value)))
    return df.filter(F.col(time) == F.lit(value))


def argmin_by_group(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """WIN4: the row of the minimum per group as one aggregate (``min_by``), tie -> smallest row."""
    rest = [c for c in df.columns if c not in by]
    got = df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(F.col(value), *[F.col(c) for c in rest])).alias("_r"))
    return got.select(*by, *[F.col(f"_r.{c}").alias(c) for c in rest])


def numeric_feature_columns(df: DataFrame, identifiers: Sequence[str] = (), target: str | None = None,
                            extra_exclude: Sequence[str] = (), extra_include: Sequence[str] = ()) -> list[str]:
    """PRJ10: numeric minus identifiers minus excludes minus target, plus includes."""
    skip = set(identifiers) | set(extra_exclude) | ({target} if target else set())
    cols = numeric_columns(df, tuple(skip))
    return cols + [c for c in extra_include if c not in cols and c in df.columns]
