"""Correlation and covariance (COR1-COR6, TOP1, RSH4).

All matrices come from one pass: pairwise-complete moments, or one GRAM where
complete cases are asked for.  The k x k result is turned into tidy frames on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import numeric_columns, small_frame
from .gram import gram, pairwise_corr


@dataclass(frozen=True)
class CorrelationResult:
    columns: tuple[str, ...]
    matrix: np.ndarray
    target: str | None = None

    def tidy(self, spark) -> DataFrame:
        """Square matrix as (feature_a, feature_b, correlation) rows (RSH4)."""
        rows = [(a, b, float(self.matrix[i, j])) for i, a in enumerate(self.columns)
                for j, b in enumerate(self.columns)]
        return small_frame(spark, rows, "feature_a string, feature_b string, correlation double")

    def pairs(self, spark) -> DataFrame:
        """Upper-triangle pair list with abs value and an ``a vs b`` pair label (fixed label format)."""
        rows = []
        for i, a in enumerate(self.columns):
            for j in range(i + 1, len(self.columns)):
                r = float(self.matrix[i, j])
                rows.append((a, self.columns[j], r, abs(r), f"{a} vs {self.columns[j]}"))
        return small_frame(spark, rows,
                           "feature_a string, feature_b string, correlation double, abs_correlation double, pair string")

    def top_pairs(self, spark, n: int = 10, exclude_target: bool = True) -> DataFrame:
        """TOP1: n strongest pairs by |r|, ties broken by names (R28)."""
        p = self.pairs(spark)
        if exclude_target and self.target:
            p = p.filter((F.col("feature_a") != self.target) & (F.col("feature_b") != self.target))
        return p.orderBy(F.desc("abs_correlation"), "feature_a", "feature_b").limit(n)


def correlation(df: DataFrame, columns: Sequence[str] | None = None, *, target: str | None = None,
                pairwise: bool | None = None) -> CorrelationResult:
    """COR1: Pearson matrix over numeric columns.

    Pairwise-complete moments (one pass) equal the complete-case matrix where
    nothing is missing; ``pairwise=False`` asks for complete cases.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    if target and target not in cols:
        cols.append(target)
    m = gram(df, cols).corr() if pairwise is False else pairwise_corr(df, cols)
    return CorrelationResult(tuple(cols), m, target)


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """COR3: correlation of every feature with the target, strongest first.

    One aggregate of k pairwise moments (NULL-skipping per pair).
    """
    if target is None:
        raise ValueError("a target column is required")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found in data")
    feats = [f for f in features if f != target]
    m = pairwise_corr(df, [target, *feats])
    rows = [(f, float(m[0, i + 1])) for i, f in enumerate(feats)]
    spark = df.sparkSession
    return small_frame(spark, rows, "feature string, correlation double").orderBy(
        F.desc_nulls_last("correlation"), "feature")


def covariance(df: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """COR5: tidy covariance matrix (variances on the diagonal), ``ddof=1`` by default."""
    g = gram(df, columns)
    c = g.cov(ddof)
    rows = [(a, b, float(c[i, j])) for i, a in enumerate(g.columns) for j, b in enumerate(g.columns)]
    return small_frame(df.sparkSession, rows, "feature_a string, feature_b string, covariance double")


def correlation_delta(before: CorrelationResult, after: CorrelationResult, spark) -> DataFrame:
    """COR4/JOI7: join the two pair lists by feature pair and take differences."""
    a = before.pairs(spark).select("feature_a", "feature_b", F.col("correlation").alias("corr_before"))
    b = after.pairs(spark).select("feature_a", "feature_b", F.col("correlation").alias("corr_after"))
    return (a.join(b, ["feature_a", "feature_b"])
            .withColumn("delta", F.col("corr_after") - F.col("corr_before"))
            .withColumn("abs_delta", F.abs(F.col("corr_after")) - F.abs(F.col("corr_before"))))


def term_target_correlation(df: DataFrame, term: str, target: str) -> float:
    """COR6: Pearson of one model term with the target (complete pairs)."""
    return float(pairwise_corr(df, [term, target])[0, 1])


def signed_top(pairs: DataFrame, n: int = 5, column: str = "correlation") -> DataFrame:
    """TOP2/CHD4: n largest positive and n most negative values, labelled by sign."""
    pos = pairs.filter(F.col(column) > 0).orderBy(F.desc(column), *[c for c in pairs.columns if c != column]).limit(n)
    neg = pairs.filter(F.col(column) < 0).orderBy(F.asc(column), *[c for c in pairs.columns if c != column]).limit(n)
    return pos.withColumn("sign", F.lit("positive")).unionByName(neg.withColumn("sign", F.lit("negative")))
