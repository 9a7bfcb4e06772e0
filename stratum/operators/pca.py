"""Principal components (PCA1-PCA7).

Fit = one GRAM pass + ``numpy.linalg.eigh`` of the k x k covariance on the
driver.  Scores = a single projection of k-term linear combinations with
literal loadings (centred, unlike ``pyspark.ml.feature.PCAModel``), so
transforming new rows or a stream costs one narrow stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import numeric_columns, small_frame
from .gram import Gram, gram


def _fix_signs(vectors: np.ndarray) -> np.ndarray:
    """R27: make the largest-|loading| entry of every component positive."""
    v = vectors.copy()
    for j in range(v.shape[1]):
        i = int(np.argmax(np.abs(v[:, j])))
        if v[i, j] < 0:
            v[:, j] = -v[:, j]
    return v


@dataclass(frozen=True)
class PCAModel:
    columns: tuple[str, ...]
    means: np.ndarray
    components: np.ndarray  # k x m, unit-norm columns
    variances: np.ndarray  # m eigenvalues (ddof=1)
    total_variance: float
    prefix: str = "PC"

    @property
    def n_components(self) -> int:
        return self.components.shape[1]

    def names(self) -> list[str]:
        return [f"{self.prefix}{j + 1}" for j in range(self.n_components)]

    def score_columns(self, names: Sequence[str] | None = None) -> dict[str, Column]:
        """PCA2: centred projection as Column expressions."""
        names = list(names) if names is not None else self.names()
        out = {}
        for j, nm in enumerate(names):
            expr = None
            for i, c in enumerate(self.columns):
                term = (F.col(c) - F.lit(float(self.means[i]))) * F.lit(float(self.components[i, j]))
                expr = term if expr is None else expr + term
            out[nm] = expr
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """PCA2/PCA6: scores for any DataFrame with the fitted columns."""
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise KeyError(f"missing columns for PCA transform: {missing}")
        return df.select(*keep, *[e.alias(n) for n, e in self.score_columns().items()])

    def explained_variance(self, spark) -> DataFrame:
        """PCA3: PC, variance, explained_ratio, cumulative_ratio."""
        ratio = self.variances / self.total_variance
        cum = np.cumsum(ratio)
        rows = [(n, float(v), float(r), float(c)) for n, v, r, c in zip(self.names(), self.variances, ratio, cum)]
        return small_frame(spark, rows, "PC string, variance double, explained_ratio double, cumulative_ratio double")

    def loadings(self, spark) -> DataFrame:
        """PCA4: tidy (feature, PC, loading)."""
        rows = [(c, n, float(self.components[i, j])) for j, n in enumerate(self.names())
                for i, c in enumerate(self.columns)]
        return small_frame(spark, rows, "feature string, PC string, loading double")

    def feature_ranking(self, spark, n_pcs: int | None = None, method: str = "l2") -> DataFrame:
        """PCA5: strength of each feature over the leading PCs (``l2`` or ``max``)."""
        m = n_pcs or self.n_components
        block = self.components[:, :m]
        if method == "l2":
            score = np.sqrt((block ** 2).sum(axis=1))
        elif method == "max":
            score = np.abs(block).max(axis=1)
        else:
            raise ValueError(f"unknown method {method!r}; use 'l2' or 'max'")
        rows = [(c, float(s)) for c, s in zip(self.columns, score)]
        return small_frame(spark, rows, "feature string, score double").orderBy(F.desc("score"), "feature")

    def biplot_scale(self, df: DataFrame, top: int = 5) -> tuple[list[str], float]:
        """PCA7: top-loading features on PC1/PC2 and the arrow scale max|score|/max|loading|."""
        sc = self.transform(df)
        agg = sc.agg(*[F.max(F.abs(F.col(n))).alias(n) for n in self.names()[:2]]).first()
        max_score = max(float(agg[n] or 0.0) for n in self.names()[:2])
        block = np.abs(self.components[:, :2])
        strength = np.sqrt((block ** 2).sum(axis=1))
        order = np.argsort(-strength, kind="stable")[:top]
        return [self.columns[i] for i in order], max_score / float(block.max() or 1.0)


def pca_from_gram(g: Gram, n_components: int | None = None, prefix: str = "PC") -> PCAModel:
    cov = g.cov(ddof=1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0.0, None), _fix_signs(vecs[:, order])
    m = g.k if n_components is None else min(n_components, g.k)
    return PCAModel(g.columns, g.means, vecs[:, :m], vals[:m], float(np.trace(cov)), prefix)


def fit_pca(df: DataFrame, columns: Sequence[str] | None = None, n_components: int | None = None,
            exclude: Sequence[str] = ()) -> PCAModel:
    """PCA1: fit on complete cases of the chosen numeric columns."""
    cols = list(columns) if columns is not None else numeric_columns(df, exclude)
    cols = [c for c in cols if c not in set(exclude)]
    if not cols:
        raise ValueError("no columns to fit PCA on")
    return pca_from_gram(gram(df, cols), n_components)
