"""Hold-out evaluation, bootstrap and calibration (EVA1-EVA6, MET4).

Evaluation of any number of models is one projection (one prediction column
per model) and one aggregate.  Bootstrap replicates are Poisson(1) weights
from ``md5(replicate|row key)``; the statistics of all replicates are one
matrix product per Arrow batch (:func:`gram.replicate_grams`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..frames import small_frame
from ..functions.hashrand import poisson1_table, row_key, uniform
from .gram import replicate_grams
from .ols import Y, OLSModel, design_frame, model_from_gram
from .profile import quantile_bin_expr, quantile_edges
from .quantiles import quantiles
from .terms import expand


def split(df: DataFrame, key: Sequence[str], test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """EVA6: deterministic hash split (the same rows in every engine)."""
    u = uniform(seed, *key)
    return df.filter(u >= test_share), df.filter(u < test_share)


def evaluate(models: dict[str, OLSModel], df: DataFrame) -> DataFrame:
    """EVA1: per model n, RMSE, MAE, R2 on new data after dropping its missing rows.

    All predictions are columns of ONE projection and all metrics ONE aggregate.
    """
    cols, aggs, structs = [], [], []
    for i, (name, m) in enumerate(models.items()):  # columns by position: a model may have any name
        ok = F.col(m.target).isNotNull()
        for t in m.terms:
            ok = ok & t.expr.isNotNull()
        yhat = m.predict_expr()
        cols += [F.when(ok, F.col(m.target).cast("double")).alias(f"y{i}"), F.when(ok, yhat).alias(f"p{i}")]
        y, p = F.col(f"y{i}"), F.col(f"p{i}")
        aggs += [F.count(y).alias(f"n{i}"), F.avg((y - p) * (y - p)).alias(f"mse{i}"),
                 F.avg(F.abs(y - p)).alias(f"mae{i}"), F.var_pop(y).alias(f"var{i}")]
        structs.append(F.struct(F.lit(name).alias("model"), F.col(f"n{i}").alias("n"), F.sqrt(F.col(f"mse{i}")).alias("rmse"),
                                F.col(f"mae{i}").alias("mae"), F.when(F.col(f"var{i}") > 0, F.lit(1.0) - F.col(f"mse{i}") / F.col(f"var{i}")).alias("r2")))
    row = df.select(*cols).agg(*aggs)
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def cross_period(models: dict[object, OLSModel], df: DataFrame, by: str) -> DataFrame:
    """EVA6: each period's model scored on every period: ``(trained_on, by, n, rmse, mae, r2)``, one pass."""
    scored = evaluate_by({str(k): m for k, m in models.items()}, df, by)
    return scored.withColumnRenamed("model", "trained_on")


def mean_over_periods(scored: DataFrame, model: str = "model") -> DataFrame:
    """EVA2: mean of the per-period metrics of each model."""
    return scored.groupBy(model).agg(F.count(F.lit(1)).alias("n_periods"), *[F.avg(c).alias(f"mean_{c}") for c in ("rmse", "mae", "r2")])


def evaluate_by(models: dict[str, OLSModel], df: DataFrame, by: str) -> DataFrame:
    """EVA2: the same models on every period: one ``groupBy(period)`` over a (model, y, yhat) stream."""
    structs = []
    for name, m in models.items():
        ok = F.col(m.target).isNotNull()
        for t in m.terms:
            ok = ok & t.expr.isNotNull()
        structs.append(F.when(ok, F.struct(F.lit(name).alias("model"), F.col(m.target).cast("double").alias("y"),
                                           m.predict_expr().alias("p"))))
    long = df.select(by, F.explode(F.array(*structs)).alias("r")).filter(F.col("r").isNotNull()).select(by, "r.*")
    e = F.col("y") - F.col("p")
    return long.groupBy(by, "model").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"),
                                         F.avg(F.abs(e)).alias("mae"),
                                         F.when(F.var_pop("y") > 0, F.lit(1.0) - F.avg(e * e) / F.var_pop("y")).alias("r2"))


def split_metrics(model_train: OLSModel, test: DataFrame) -> dict[str, float]:
    """MET4: train R2/RMSE/adj R2/AIC next to test R2/RMSE."""
    m = model_train.metrics()
    t = evaluate({"m": model_train}, test).first()
    return {"train_r2": m["r2"], "train_rmse": m["rmse"], "train_adj_r2": m["adj_r2"], "train_aic": m["aic"],
            "test_r2": t["r2"], "test_rmse": t["rmse"], "test_n": float(t["n"])}


def replicate_weights(n_boot: int, seed: int, key: Sequence[str]) -> tuple[Column, Callable[[pa.Array], np.ndarray]]:
    """A row's key as text, and what makes Poisson(1) weights of every replicate of such texts, each from one md5."""
    seeds = [f"{seed}:{r}" for r in range(n_boot)]
    return row_key(*key), lambda keys: poisson1_table(keys, seeds)


def bootstrap_metrics(model: OLSModel, df: DataFrame, key: Sequence[str], n_boot: int = 200, seed: int = 0,
                      alpha: float = 0.05) -> DataFrame:
    """EVA3: paired bootstrap CI of RMSE, MAE and R2 on fixed predictions."""
    ok = F.col(model.target).isNotNull()
    for t in model.terms:
        ok = ok & t.expr.isNotNull()
    y = F.col(model.target).cast("double")
    e = y - model.predict_expr()
    pred = df.filter(ok).select(*key, y.alias("_y"), e.alias("_e"), F.abs(e).alias("_a"))
    values: dict[str, list[float]] = {"rmse": [], "mae": [], "r2": []}
    for g, _ in replicate_grams(pred, ["_y", "_e", "_a"], *replicate_weights(n_boot, seed, key), n_boot):
        if not g.n:
            continue
        mse = g.cross[1, 1] / g.n + g.means[1] ** 2
        values["rmse"].append(math.sqrt(mse))
        values["mae"].append(g.means[2])
        values["r2"].append(1.0 - mse * g.n / g.cross[0, 0] if g.cross[0, 0] > 0 else math.nan)
    rows = [(m, *map(float, np.quantile(v, [alpha / 2, 0.5, 1 - alpha / 2]))) for m, v in values.items() if v]
    return small_frame(df.sparkSession, rows, "metric string, ci_low double, median double, ci_high double")


def bootstrap_refit_rmse(df: DataFrame, target: str, terms: Sequence, key: Sequence[str], n_boot: int = 200,
                         seed: int = 0) -> list[dict]:
    """EVA4: refit on every replicate, scored on the rows it leaves out; one scan for all of them."""
    from .selection import fold_sse

    ts = expand(terms, df)
    x = [f"_t{i}" for i in range(len(ts))]
    design = design_frame(df, target, ts, extra=list(key))
    out = []
    for r, (inside, outside) in enumerate(replicate_grams(design, [*x, Y], *replicate_weights(n_boot, seed, key), n_boot)):
        if inside.n > len(x) + 1 and outside.n:
            coef = model_from_gram(inside, target, ts).coef
            out.append({"_rep": r, "oob_rmse": math.sqrt(fold_sse(outside, coef, x, True) / outside.n), "n_oob": outside.rows})
    return out


def calibration(pred: DataFrame, y: str, p: str, q: int = 10, n_boot: int = 100, seed: int = 0,
                key: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """EVA5: quantile bins of the prediction: mean predicted, mean observed, bootstrap CI of the bin mean."""
    edges = quantile_edges(pred, p, q)
    if len(edges) < 3:
        return pred.sparkSession.createDataFrame([], "bin int, n long, mean_pred double, mean_obs double, "
                                                     "ci_low double, ci_high double")
    binned = pred.select(*key, F.col(y).cast("double").alias("_y"), F.col(p).alias("_p"), quantile_bin_expr(p, edges).alias("bin"))
    base = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("_p").alias("mean_pred"),
                                     F.avg("_y").alias("mean_obs")).collect()  # a row a bin
    found = replicate_grams(binned, ["_y"], *replicate_weights(n_boot, seed, key), n_boot, by="bin")
    rows = []
    for r in base:
        means = [g.means[0] for g, _ in found.get(r["bin"], []) if g.n]
        low, high = np.quantile(means, [alpha / 2, 1 - alpha / 2]) if r["n"] > 1 and means else (r["mean_obs"], r["mean_obs"])
        rows.append((r["bin"], r["n"], r["mean_pred"], r["mean_obs"], float(low), float(high)))
    return small_frame(pred.sparkSession, rows, "bin int, n long, mean_pred double, mean_obs double, ci_low double, ci_high double")


def confidence_band(model: OLSModel, spark, x: str, lo: float, hi: float, at: dict[str, Column | float],
                    n_points: int = 50, alpha: float = 0.05) -> DataFrame:
    """OLS6: mean-response band over a grid of one predictor (others fixed), ``sqrt(x' C x)`` as an expression."""
    grid = spark.range(n_points).select((F.lit(lo) + F.col("id") * F.lit((hi - lo) / max(n_points - 1, 1))).alias(x))
    grid = grid.select(x, *[(v if isinstance(v, Column) else F.lit(float(v))).alias(k) for k, v in at.items()])
    return _band(model, grid, x, alpha)


def _band(model: OLSModel, grid: DataFrame, x: str, alpha: float) -> DataFrame:
    from ..functions import tails

    se = F.sqrt(F.lit(model.sigma2) * model.leverage_expr())
    q = tails.t_ppf(1 - alpha / 2, model.df_resid)
    fit = model.predict_expr()
    return grid.select(x, fit.alias("fit"), (fit - F.lit(q) * se).alias("lower"), (fit + F.lit(q) * se).alias("upper"))


def _categories(model: OLSModel) -> set[str]:
    return {t.source[0] for t in model.terms if t.name.startswith("C(")}


def typical_values(model: OLSModel, df: DataFrame, but: Sequence[str] = ()) -> dict[str, object]:
    """A value for each column that the model reads: mean of a number, first level of ``C()``, most frequent value of others.

    NULL counts for none of them; the smaller of two equally frequent values is
    taken; a column without any value is NULL.  Numbers and first levels take one
    aggregate together, a most frequent value one count of its column.
    """
    columns = [c for c in dict.fromkeys(c for t in model.terms for c in t.source) if c not in but]
    levels, numbers = _categories(model), {f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))}
    once = {c: F.min(F.col(c)) if c in levels else F.avg(F.col(c).cast("double")) for c in columns if c in levels or c in numbers}
    found = df.agg(*[e.alias(c) for c, e in once.items()]).first().asDict() if once else {}
    for c in columns:
        if c not in found:
            top = df.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).first()
            found[c] = top[c] if top else None
    return {c: found[c] for c in columns}


def _levels(df: DataFrame, column: str, max_levels: int) -> list:
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_levels + 1).collect()  # bounded read
    if len(found) > max_levels:
        raise ValueError(f"{column!r} has more than {max_levels} values: name levels or probs")
    return sorted(r[0] for r in found)


def effect_band(model: OLSModel, df: DataFrame, x: str, n_points: int = 300, alpha: float = 0.05, max_levels: int = 50) -> DataFrame:
    """OLS6: mean response and band along one predictor, every other one at its typical value in ``df``.

    A number runs over ``n_points`` even steps of its range; a ``C()`` column
    over its levels.  A column that the model does not read is a ``KeyError``.
    """
    if x not in {c for t in model.terms for c in t.source}:
        raise KeyError(f"{x!r} is no predictor of the model")
    spark, at = df.sparkSession, typical_values(model, df, but=[x])
    if x in _categories(model):
        grid = spark.createDataFrame([(v,) for v in _levels(df, x, max_levels)], T.StructType([T.StructField(x, df.schema[x].dataType)]))
    else:
        lo, hi = df.agg(F.min(x).cast("double"), F.max(x).cast("double")).first()
        grid = spark.range(n_points).select((F.lit(lo) + F.col("id") * F.lit((hi - lo) / max(n_points - 1, 1))).alias(x))
    return _band(model, grid.select(x, *[F.lit(v).alias(c) for c, v in at.items()]), x, alpha)


def interaction_grid(model: OLSModel, df: DataFrame, x: str, by: str, n_points: int = 12,
                     levels: Sequence | None = None, probs: Sequence[float] | None = None, max_levels: int = 50) -> DataFrame:
    """OLS7: predictions over a grid of ``x`` for chosen values of ``by``.

    The caller says which: ``levels``, or quantiles at ``probs``, or neither for
    every distinct value of a category (an error above ``max_levels``: a grid of
    a continuous column is never silently thinned out).  NULL is no level.
    Other predictors of the model stay at their typical values in ``df``.
    """
    if levels is None and probs is not None:
        levels = sorted(set(quantiles(df, [by], list(probs))[by]) - {None})
    elif levels is None:
        levels = _levels(df, by, max_levels)
    lo, hi = df.agg(F.min(x).cast("double"), F.max(x).cast("double")).first()
    step = (hi - lo) / max(n_points - 1, 1)
    kind = df.schema[by].dataType.simpleString() if probs is None else "double"
    rows = [(lo + i * step, v) for v in levels for i in range(n_points)]
    grid = df.sparkSession.createDataFrame(rows, f"`{x}` double, `{by}` {kind}")
    return model.predict(grid.select("*", *[F.lit(v).alias(c) for c, v in typical_values(model, df, but=[x, by]).items()]), keep=[by, x])
