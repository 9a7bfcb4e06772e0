"""Outlier detection: IQR fences, z-scores, residual outliers, detector comparison,
representative-period score (OUT1, OUT2, OUT4, OUT5, OUT6).

Fitting is one aggregate (quartiles or mean/sd per column); flagging is a
projection with literal fences, so masks are computed in the same stage as
the scan and never materialised separately.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import small_frame
from .quantiles import grouped_quantiles, quantiles


@dataclass(frozen=True)
class Fences:
    columns: tuple[str, ...]
    lower: tuple[float | None, ...]
    upper: tuple[float | None, ...]
    method: str

    def masks(self) -> dict[str, Column]:
        out = {}
        for c, lo, hi in zip(self.columns, self.lower, self.upper):
            col = F.col(c)
            if lo is None or hi is None:
                out[f"{c}_outlier"] = F.lit(False)
            else:
                out[f"{c}_outlier"] = F.coalesce((col < F.lit(lo)) | (col > F.lit(hi)), F.lit(False))
        return out

    def flag(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Boolean mask per column plus the number of flags per row."""
        m = self.masks()
        n = sum((e.cast("int") for e in m.values()), F.lit(0))
        return df.select(*keep, *[e.alias(k) for k, e in m.items()], n.alias("n_flags"))

    def counts(self, df: DataFrame) -> DataFrame:
        """Flags per column in one aggregate, tidy."""
        m = self.masks()
        row = df.agg(*[F.sum(e.cast("long")).alias(f"n{i}") for i, e in enumerate(m.values())])
        structs = [F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n_outliers"))
                   for i, c in enumerate(self.columns)]
        return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")

    def to_frame(self, spark) -> DataFrame:
        return small_frame(spark, list(zip(self.columns, self.lower, self.upper)),
                           "feature string, lower double, upper double")


def iqr_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> Fences:
    """OUT1: ``[q1 - k iqr, q3 + k iqr]`` from exact quartiles (see ``quantiles.quantiles``)."""
    qs = quantiles(df, columns, [0.25, 0.75])
    lo, hi = [], []
    for c in columns:
        q = qs[c]
        if q[0] is None:
            lo.append(None)
            hi.append(None)
            continue
        iqr = q[1] - q[0]
        lo.append(q[0] - k * iqr)
        hi.append(q[1] + k * iqr)
    return Fences(tuple(columns), tuple(lo), tuple(hi), "iqr")


def zscore_fences(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> Fences:
    """OUT2: ``|x - mean| / sd > t`` with the *sample* sd (R3); n = 1 -> never flagged."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    lo, hi = [], []
    for i, _ in enumerate(columns):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is None or s is None:
            lo.append(None)
            hi.append(None)
        else:
            lo.append(m - threshold * s)
            hi.append(m + threshold * s)
    return Fences(tuple(columns), tuple(lo), tuple(hi), "zscore")


def compare_detectors(flagged: dict[str, DataFrame]) -> DataFrame:
    """OUT5: per detector rows, rows flagged, share flagged, median flags per flagged row.

    Each input is a ``Fences.flag`` output (column ``n_flags``).
    """
    out = None
    for name, f in flagged.items():
        s = f.agg(F.count(F.lit(1)).alias("n_rows"), F.sum((F.col("n_flags") > 0).cast("long")).alias("n_flagged"),
                  F.percentile(F.col("n_flags").cast("double"), F.lit(0.5)).alias("median_flags"))
        s = s.withColumn("share_flagged", F.col("n_flagged") / F.col("n_rows")).withColumn("detector", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


def anomaly_share_by_period(df: DataFrame, time: str, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """OUT6 piece: per period, share of rows with any IQR flag, with fences fitted *per period*.

    The fences are a table of one row per period, joined back on the period.
    """
    fences = grouped_quantiles(df, columns, [0.25, 0.75], time)
    joined = df.join(fences, time)
    any_flag = F.lit(False)
    for i, c in enumerate(columns):
        q1, q3 = F.col(f"q{i}_0"), F.col(f"q{i}_1")
        iqr = q3 - q1
        any_flag = any_flag | F.coalesce((F.col(c) < q1 - k * iqr) | (F.col(c) > q3 + k * iqr), F.lit(False))
    return joined.groupBy(time).agg(F.avg(any_flag.cast("double")).alias("outlier_share"),
                                    F.count(F.lit(1)).alias("n_rows"))


def period_score(missing: DataFrame, outliers: DataFrame, time: str, w_missing: float = 0.8,
                 w_outlier: float = 0.2) -> DataFrame:
    """OUT6: ``w_m (100 - missing%) + w_o (100 - outlier%)`` per period, best first (ties: latest)."""
    j = missing.join(outliers, time)
    score = F.lit(w_missing) * (100.0 - F.col("avg_missing_pct")) + F.lit(w_outlier) * (100.0 - 100.0 * F.col("outlier_share"))
    return j.withColumn("score", score).orderBy(F.desc("score"), F.desc(time))


def minmax_scaled(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """WIN7: min-max normalisation to 0..100 from one scalar aggregate."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    span = (hi - lo) if hi is not None and hi != lo else 1.0
    return df.withColumn(name or f"{column}_scaled", (F.col(column) - F.lit(lo)) * 100.0 / F.lit(span))
