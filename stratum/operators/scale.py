"""Standardization and feature transforms (STD1-STD5, CLN3/CLN4).

A fitted scaler is a handful of numbers (mean, sd per column).  Fitting is one
aggregate; applying it is a projection with literals, so the same model scales
a training slice, a hold-out year (STD4) or a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import numeric_columns, small_frame


@dataclass(frozen=True)
class ScalerModel:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    sds: tuple[float, ...]

    def expressions(self) -> dict[str, Column]:
        out = {}
        for c, m, s in zip(self.columns, self.means, self.sds):
            if m is None:
                out[c] = F.col(c).cast("double")
            elif not s:
                out[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))  # constant column -> 0
            else:
                out[c] = (F.col(c) - F.lit(m)) / F.lit(s)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.expressions())

    def to_frame(self, spark) -> DataFrame:
        return small_frame(spark, list(zip(self.columns, self.means, self.sds)),
                           "feature string, mean double, sd double")


def fit_scaler(df: DataFrame, columns: Sequence[str], ddof: int = 0) -> ScalerModel:
    """STD1 fit: one ``agg`` of avg and population (ddof=0) or sample sd."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[sd(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return ScalerModel(tuple(columns), tuple(row[f"m{i}"] for i in range(len(columns))),
                       tuple(row[f"s{i}"] for i in range(len(columns))))


def standardize(df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = (),
                ddof: int = 0) -> tuple[DataFrame, ScalerModel]:
    """STD1: z-score numeric columns (population sd), leave others untouched."""
    cols = list(columns) if columns is not None else numeric_columns(df, exclude)
    model = fit_scaler(df, cols, ddof)
    return model.transform(df), model


def apply_transforms(df: DataFrame, tf_map: Mapping[str, Callable | None],
                     overrides: Mapping[str, Callable | None] | None = None) -> DataFrame:
    """STD2: one ``select`` applying per-column transforms.

    A transform returns a Column (replaces the input) or a dict of new columns
    (the input is dropped, e.g. dummies).  ``None`` in ``overrides`` removes a
    default transform.  Columns without a transform pass through.
    """
    merged = dict(tf_map)
    for k, v in (overrides or {}).items():
        if v is None:
            merged.pop(k, None)
        else:
            merged[k] = v
    out: list[Column] = []
    for name in df.columns:
        fn = merged.get(name)
        if fn is None:
            out.append(F.col(name))
            continue
        res = fn(F.col(name))
        if isinstance(res, dict):
            out.extend(v.alias(k) for k, v in res.items())
        else:
            out.append(res.alias(name))
    return df.select(*out)


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact column medians (linear interpolation)."""
    from .quantiles import quantiles

    return {c: v[0] for c, v in quantiles(df, list(columns), [0.5]).items()}


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """CLN3/CLN4: replace NULL by the column median."""
    med = medians(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in med.items() if v is not None})


def tf_and_norm(df: DataFrame, features: Sequence[str], tf_map: Mapping[str, Callable | None] | None = None,
                overrides: Mapping[str, Callable | None] | None = None) -> tuple[DataFrame, ScalerModel]:
    """STD3: transform -> median fill -> z-score, on the feature list only.

    Target, time, identifiers and dummies are never touched because they are
    not in ``features``.  Transforms that expand are not scaled.
    """
    sub = {k: v for k, v in (tf_map or {}).items() if k in features}
    transformed = apply_transforms(df, sub, overrides)
    scale_cols = [c for c in features if c in transformed.columns]
    filled = fill_median(transformed, scale_cols)
    model = fit_scaler(filled, scale_cols, ddof=0)
    return model.transform(filled), model


def std_summary(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """STD5: mean and population sd per column before and after, long form (one aggregate each)."""

    def one(df: DataFrame, label: str) -> DataFrame:
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)])
        structs = [F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("sd"))
                   for i, c in enumerate(columns)]
        return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*").withColumn("stage", F.lit(label))

    return one(before, "before").unionByName(one(after, "after"))
