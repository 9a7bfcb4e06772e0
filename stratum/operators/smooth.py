"""Smoothing, forest and MLlib-backed regressors (OLS10, OLS11, OLS12).

LOWESS is re-aimed for scale: exact local regression needs every pair of
points.  Instead x is cut into quantile bins (AGG19); each bin contributes
its sufficient statistics (n, sum x, sum y, sum x^2, sum xy) from one
aggregate, and the local linear fit at every bin centre combines the bins
within the span with tricube weights - B bins on the driver, not n points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import small_frame
from ..functions.hashrand import uniform
from .profile import quantile_bin_expr, quantile_edges


def binned_lowess(df: DataFrame, x: str, y: str, frac: float = 2.0 / 3.0, bins: int = 100) -> DataFrame:
    """OLS11: (x_center, fitted) of a local linear smoother over quantile bins."""
    edges = quantile_edges(df.filter(F.col(y).isNotNull()), x, bins)
    if len(edges) < 3:
        return small_frame(df.sparkSession, [], "bin int, x_center double, fitted double, n long")
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    st = (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
          .groupBy(quantile_bin_expr(x, edges).alias("bin"))
          .agg(F.count(F.lit(1)).alias("n"), F.sum(xs).alias("sx"), F.sum(ys).alias("sy"),
               F.sum(xs * xs).alias("sxx"), F.sum(xs * ys).alias("sxy")).orderBy("bin").collect())  # <= bins rows
    n = np.array([r["n"] for r in st], float)
    sx, sy = np.array([r["sx"] for r in st]), np.array([r["sy"] for r in st])
    sxx, sxy = np.array([r["sxx"] for r in st]), np.array([r["sxy"] for r in st])
    centers = sx / n
    total = n.sum()
    span = max(frac * total, 1.0)
    rows = []
    for i, c in enumerate(centers):
        dist = np.abs(centers - c)
        order = np.argsort(dist, kind="stable")
        cum = np.cumsum(n[order])
        h = dist[order][min(np.searchsorted(cum, span), len(order) - 1)] or 1e-12
        w = np.clip(1 - (dist / (h * 1.0000001)) ** 3, 0, None) ** 3
        W, Wx, Wy = (w * n).sum(), (w * sx).sum(), (w * sy).sum()
        Wxx, Wxy = (w * sxx).sum(), (w * sxy).sum()
        den = W * Wxx - Wx * Wx
        b = (W * Wxy - Wx * Wy) / den if abs(den) > 1e-12 else 0.0
        a = (Wy - b * Wx) / W
        rows.append((int(st[i]["bin"]), float(c), float(a + b * c), int(n[i])))
    return small_frame(df.sparkSession, rows, "bin int, x_center double, fitted double, n long")


def random_forest(df: DataFrame, target: str, features: Sequence[str], key: Sequence[str], n_trees: int = 300,
                  test_share: float = 0.2, seed: int = 42, max_depth: int = 8):
    """OLS10: random forest on a hash 80/20 split; returns (test metrics, importances)."""
    from .forest import fit

    data = df.dropna(subset=[target, *features]).withColumn("_held", uniform(seed, *key) < test_share)
    forest, pred = fit(data, target, features, key, "_held", n_trees, max_depth, seed)
    e = F.col("y") - F.col("prediction")
    metrics = pred.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"),
                       F.avg(F.abs(e)).alias("mae"), (F.lit(1.0) - F.avg(e * e) / F.var_pop("y")).alias("r2"))
    imp = small_frame(df.sparkSession, [(f, float(v)) for f, v in zip(features, forest.importances)],
                      "feature string, importance double")
    return metrics, imp


def residual_calibration(resid: DataFrame, categorical: Sequence[str], numeric: Sequence[str], key: Sequence[str],
                         test_share: float = 0.2, seed: int = 42, reg: float = 0.01, elastic: float = 0.5):
    """OLS12 (re-aimed): elastic-net linear model of residuals on one-hot categories + numeric offsets.

    Returns test metrics of the calibrated prediction (``resid - fitted correction``).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_oh" for c in categorical],
                        handleInvalid="keep")
    vec = VectorAssembler(inputCols=[f"{c}_oh" for c in categorical] + list(numeric), outputCol="features")
    lr = LinearRegression(labelCol="resid", featuresCol="features", regParam=reg, elasticNetParam=elastic)
    u = uniform(seed, *key)
    train, test = resid.filter(u >= test_share), resid.filter(u < test_share)
    model = Pipeline(stages=[*idx, ohe, vec, lr]).fit(train)
    pred = model.transform(test)
    before = F.col("resid")
    after = F.col("resid") - F.col("prediction")
    return pred.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(before * before)).alias("rmse_before"),
                    F.sqrt(F.avg(after * after)).alias("rmse_after"))
