"""Regression diagnostics (DIA1-DIA10, OUT4, MET1 row metrics, CHD7, CHD8).

Row-level influence (leverage, studentized residual, Cook's distance) is one
projection: the p x p inverse Gram enters as literals in a quadratic form.
Assumption tests use at most three more passes over the rows:

1. one aggregate: residual moments, MAE/MAPE, influence maxima and counts;
2. one auxiliary GRAM over [design, squares, cross products, e^2] that
   yields both Breusch-Pagan and White statistics;
3. ordered passes (Durbin-Watson in the caller's order, Anderson-Darling in
   residual order) over range partitions, streaming one Arrow batch at a time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import small_frame
from ..functions import tails
from .gram import gram
from .ols import OLSModel, model_from_gram, solve_from_gram
from .rank import ordered_partition_stats
from .terms import Term


def influence(model: OLSModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """DIA7/DIA8/CHD7: y, fitted, resid, leverage, studentized, cooks_d (complete cases)."""
    s2, p = model.sigma2, model.n_params
    cond = F.col(model.target).isNotNull()
    for t in model.terms:
        cond = cond & t.expr.isNotNull()
    yhat = model.predict_expr()
    h = model.leverage_expr()
    out = df.filter(cond).select(*keep, F.col(model.target).cast("double").alias("y"), yhat.alias("fitted"),
                                 (F.col(model.target) - yhat).alias("resid"), h.alias("leverage"))
    r = F.col("resid") / F.sqrt(F.lit(s2) * (F.lit(1.0) - F.col("leverage")))
    return (out.withColumn("studentized", r)
            .withColumn("cooks_d", r * r / F.lit(float(p)) * F.col("leverage") / (F.lit(1.0) - F.col("leverage"))))


def _erfc(x: np.ndarray) -> np.ndarray:
    """Vectorised complementary error function (Chebyshev fit, relative error < 1.2e-7)."""
    z = np.abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    c = tails.ERFC_COEFFS
    poly = c[-1]
    for coef in reversed(c[1:-1]):
        poly = coef + t * poly
    ans = t * np.exp(-z * z + c[0] + t * poly)
    return np.where(x >= 0, ans, 2.0 - ans)


def durbin_watson(df: DataFrame, resid: str, order: Sequence[str]) -> float:
    """DIA1: ``sum (e_t - e_{t-1})^2 / sum e_t^2`` in the given order (range partitions, one pass)."""

    def per_batch(v, start, prev):
        d = np.diff(v)
        s = float(d @ d)
        if prev is not None:
            s += (v[0] - prev) ** 2
        return {"sd": s, "ss": float(v @ v)}

    parts = ordered_partition_stats(df, order, resid, per_batch)
    num = sum(p["sd"] for p in parts) + sum((parts[i]["_first"] - parts[i - 1]["_last"]) ** 2
                                            for i in range(1, len(parts)))
    den = sum(p["ss"] for p in parts)
    return num / den if den > 0 else float("nan")


def anderson_darling(df: DataFrame, column: str, moments: tuple[int, float, float] | None = None) -> tuple[float, float]:
    """DIA3: Anderson-Darling normality test (mean and sample sd estimated).

    Ranks come from range partitions ordered by the value; each partition
    returns rank-weighted sums and the driver adds partition offsets.
    ``moments`` = (n, mean, sample sd) when the caller already has them.
    """
    if moments is None:
        m = df.agg(F.count(column).alias("n"), F.avg(column).alias("m"), F.stddev_samp(column).alias("s")).first()
        moments = (int(m["n"]), float(m["m"]), float(m["s"] or 0.0))
    n, mu, sd = moments
    if n < 3 or sd <= 0:
        return float("nan"), float("nan")

    def per_batch(v, start, prev):
        z = (v - mu) / sd
        a, b = (np.log(np.clip(0.5 * _erfc(t / math.sqrt(2.0)), 1e-300, None)) for t in (-z, z))  # both tails, neither as a difference from 1
        ll = start + 1.0 + np.arange(v.size)
        return {"a1": float(((2 * ll - 1) * a).sum()), "a0": float(a.sum()),
                "b1": float(((1 - 2 * ll) * b).sum()), "b0": float(b.sum())}

    parts = ordered_partition_stats(df.filter(F.col(column).isNotNull()), [column], column, per_batch)
    total, off = 0.0, 0.0
    for p in parts:
        total += p["a1"] + 2 * off * p["a0"] + 2 * n * p["b0"] + p["b1"] - 2 * off * p["b0"]
        off += p["_n"]
    a2 = -n - total / n
    a2a = a2 * (1 + 0.75 / n + 2.25 / n ** 2)
    # D'Agostino-Stephens p-value approximation for the adjusted statistic.
    if a2a < 0.2:
        pval = 1 - math.exp(-13.436 + 101.14 * a2a - 223.73 * a2a ** 2)
    elif a2a < 0.34:
        pval = 1 - math.exp(-8.318 + 42.796 * a2a - 59.938 * a2a ** 2)
    elif a2a < 0.6:
        pval = math.exp(0.9177 - 4.279 * a2a - 1.38 * a2a ** 2)
    elif a2a <= 13:
        pval = math.exp(1.2937 - 5.709 * a2a + 0.0186 * a2a ** 2)
    else:
        pval = 0.0
    return a2, pval


def normality(df: DataFrame, column: str, moments: tuple[int, float, float] | None = None) -> dict[str, float]:
    """DIA3: Anderson-Darling at every size."""
    a2, p = anderson_darling(df, column, moments)
    return {"normality_stat": a2, "normality_pvalue": p}


def assumption_checks(model: OLSModel, df: DataFrame, order: Sequence[str] | None = None) -> dict[str, float]:
    """DIA1-DIA8: DW, JB, AD, BP, White, condition number, max VIF, leverage and Cook summaries."""
    # five passes read the model's columns: keep only those (spillable) instead of
    # recomputing the input for every pass
    need = list(dict.fromkeys([*(order or []), model.target, *[c for t in model.terms for c in t.source]]))
    base = df.select(*need).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _checks(model, base, influence(model, base, keep=list(order or [])), order)
    finally:
        base.unpersist()


def _checks(model: OLSModel, df: DataFrame, infl: DataFrame, order: Sequence[str] | None) -> dict[str, float]:
    """The independent passes (moments, auxiliary Gram, ordered DW pass) are submitted
    as concurrent Spark jobs; the normality pass follows once the moments are known."""
    from concurrent.futures import ThreadPoolExecutor

    n = model.n

    def moments():
        return infl.agg(F.skewness("resid").alias("skew"), F.kurtosis("resid").alias("kurt"),
                        F.max("leverage").alias("max_leverage"), F.max("cooks_d").alias("max_cooks"),
                        F.sum((F.col("cooks_d") > 4.0 / n).cast("long")).alias("n_cooks_gt_4n"),
                        F.count("resid").alias("n"), F.avg("resid").alias("m"),
                        F.stddev_samp("resid").alias("s")).first()

    with ThreadPoolExecutor(max_workers=3) as pool:
        f_mom = pool.submit(moments)
        f_het = pool.submit(het_tests, model, df)
        f_dw = pool.submit(durbin_watson, infl, "resid", order) if order else None
        mom = f_mom.result()
        f_norm = pool.submit(normality, infl, "resid", (int(mom["n"]), float(mom["m"]), float(mom["s"] or 0.0)))
        bp, bp_p, white, white_p = f_het.result()
        dw = f_dw.result() if f_dw else float("nan")
        norm = f_norm.result()
    skew, kurt = float(mom["skew"] or 0.0), float(mom["kurt"] or 0.0)
    jb = n / 6.0 * (skew ** 2 + kurt ** 2 / 4.0)
    out = {
        "jarque_bera": jb, "jarque_bera_pvalue": math.exp(-jb / 2.0),
        "breusch_pagan": bp, "breusch_pagan_pvalue": bp_p, "white": white, "white_pvalue": white_p,
        "condition_number": model.condition_number(),
        "max_vif": max(model.vif().values()) if model.terms else float("nan"),
        "max_leverage": float(mom["max_leverage"]), "max_cooks_d": float(mom["max_cooks"]),
        "n_cooks_gt_4n": float(mom["n_cooks_gt_4n"]),
    }
    out.update(norm)
    out["durbin_watson"] = dw
    return out


def het_tests(model: OLSModel, df: DataFrame) -> tuple[float, float, float, float]:
    """DIA4/DIA5: Breusch-Pagan (Koenker) and White LM tests from ONE auxiliary Gram.

    Auxiliary regressors: design terms (BP) plus their squares and pairwise
    products (White); response ``e^2``.  ``LM = n R^2``, chi-square tails.
    """
    k = len(model.terms)
    base = [t.expr for t in model.terms]
    extra: list[Column] = []
    for i in range(k):
        for j in range(i, k):
            extra.append(base[i] * base[j])
    cond = F.col(model.target).isNotNull()
    for t in model.terms:
        cond = cond & t.expr.isNotNull()
    e = F.col(model.target) - model.predict_expr()
    cols = [*base, *extra]
    aux = df.filter(cond).select(*[c.cast("double").alias(f"_a{i}") for i, c in enumerate(cols)],
                                 (e * e).alias("_e2"))
    names = [f"_a{i}" for i in range(len(cols))]
    g = gram(aux, [*names, "_e2"])

    def lm(idx: list[int]) -> tuple[float, float]:
        sub = [names[i] for i in idx]
        # drop columns that are constant or duplicates (e.g. squares of dummies)
        keep, seen = [], []
        for c in sub:
            j = g.index([c])[0]
            if g.cross[j, j] <= 1e-12 * max(1.0, abs(g.means[j])):
                continue
            v = g.cross[j, :]
            if any(np.allclose(v, g.cross[s, :], rtol=1e-9, atol=1e-12) for s in seen):
                continue
            keep.append(c)
            seen.append(j)
        if not keep:
            return float("nan"), float("nan")
        _, _, rss, tss = solve_from_gram(g, keep, "_e2", True)
        stat = g.n * (1 - rss / tss) if tss > 0 else float("nan")
        return stat, tails.chi2_sf(stat, len(keep))

    bp = lm(list(range(k)))
    white = lm(list(range(len(cols))))
    return bp[0], bp[1], white[0], white[1]


def residual_metrics(model: OLSModel, df: DataFrame) -> dict[str, float | None]:
    """MET1 row metrics in one aggregate: MAE, MAPE (NULL when any y = 0, R16), RMSE, R2."""
    r = model.residuals(df)
    m = r.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs("resid")).alias("mae"),
              F.avg(F.abs(F.col("resid")) / F.abs(F.col("y"))).alias("mape"),
              F.sum((F.col("y") == 0).cast("long")).alias("n_zero"),
              F.avg(F.col("resid") * F.col("resid")).alias("mse")).first()
    return {"mae": m["mae"], "mape": None if m["n_zero"] else m["mape"], "rmse": math.sqrt(m["mse"]),
            "n": float(m["n"])}


def verdicts(checks: dict[str, float], alpha: float = 0.05) -> dict[str, str]:
    """DIA10: p < alpha -> FAIL else OK; Durbin-Watson OK inside [1.5, 2.5]."""
    out = {}
    for k in ("jarque_bera", "normality", "breusch_pagan", "white"):
        p = checks.get(f"{k}_pvalue")
        out[k] = "n/a" if p is None or not math.isfinite(p) else ("FAIL" if p < alpha else "OK")
    dw = checks.get("durbin_watson")
    out["durbin_watson"] = "n/a" if dw is None or not math.isfinite(dw) else ("OK" if 1.5 <= dw <= 2.5 else "FAIL")
    return out


def assumption_table(spark, checks_by_model: dict[str, dict[str, float]]) -> DataFrame:
    """DIA9: one row per model and check, with the DIA10 verdict."""
    rows = []
    for name, checks in checks_by_model.items():
        v = verdicts(checks)
        for k, val in checks.items():
            rows.append((name, k, float(val) if val is not None else None, v.get(k.replace("_pvalue", ""), None)
                         if k.endswith("_pvalue") or k == "durbin_watson" else None))
    return small_frame(spark, rows, "model string, check string, value double, verdict string")


def residual_outliers(model: OLSModel, df: DataFrame, keep: Sequence[str] = (), method: str = "zscore",
                      threshold: float = 3.0) -> DataFrame:
    """OUT4: flag rows by z-score or IQR of studentized residuals."""
    from .outliers import iqr_fences, zscore_fences

    infl = influence(model, df, keep)
    fences = zscore_fences(infl, ["studentized"], threshold) if method == "zscore" else iqr_fences(
        infl, ["studentized"], 1.5)
    return infl.withColumns(fences.masks())


def qq_points(infl: DataFrame, column: str = "studentized", m: int = 99) -> DataFrame:
    """CHD8: m sample quantiles of ``column`` against normal quantiles (m points, not n)."""
    probs = [(i + 0.5) / m for i in range(m)]
    from .quantiles import quantiles

    qs = quantiles(infl, [column], probs)[column]
    rows = [(p, tails.norm_ppf(p), float(q)) for p, q in zip(probs, qs)]
    return small_frame(infl.sparkSession, rows, "prob double, theoretical double, sample double")


def refit_without(model: OLSModel, df: DataFrame, max_cooks: float | None = None) -> tuple[OLSModel, DataFrame]:
    """FLT7/REG2 helper: drop rows with Cook's D above the bound (default 4/n) and refit."""
    bound = 4.0 / model.n if max_cooks is None else max_cooks
    if bound <= 0:
        raise ValueError("Cook's distance bound must be positive")
    # the whole row travels as one column, so no name of the table can clash with the influence columns
    rows = df.select("*", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    kept = influence(model, rows, keep=["_row"]).filter(F.col("cooks_d") <= F.lit(bound)).select("_row.*")
    terms: list[Term] = list(model.terms)
    g = gram(kept.select(*[t.expr.cast("double").alias(f"_t{i}") for i, t in enumerate(terms)],
                         F.col(model.target).cast("double").alias("_y")),
             [*[f"_t{i}" for i in range(len(terms))], "_y"])
    if g.n <= len(terms) + 1:
        raise ValueError("nothing left to fit after trimming")
    return model_from_gram(g, model.target, terms, intercept=model.intercept), kept
