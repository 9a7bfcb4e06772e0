"""Ordinary least squares from the Gram (OLS1-OLS5, OLS8, OLS9, MET1, MET3, MET5, DIA6).

Fitting reads the rows once (GRAM over terms + target); coefficients,
standard errors, t/F tests, information criteria, VIF and the condition
number are k x k algebra.  Fitted values, residuals and predictions are one
projection with literal coefficients.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..frames import small_frame
from ..functions import tails
from .gram import Gram, gram
from .terms import Term, check_columns, expand

Y = "_y"


def _safe_inv(a: np.ndarray) -> np.ndarray:
    """Inverse of a cross-product matrix; the pseudo-inverse if columns are collinear, whatever their units."""
    if not a.size:
        return a
    d = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    r = a / np.outer(d, d)  # unit diagonal: the rank must not depend on scale
    inv = np.linalg.pinv(r, rcond=1e-10, hermitian=True) if np.linalg.eigvalsh(r).min() <= 1e-10 else np.linalg.inv(r)
    return inv / np.outer(d, d)


def quad_form(vec: Sequence[Column], m: np.ndarray) -> Column:
    """``v' M v`` with literal coefficients."""
    expr = F.lit(0.0)
    for i in range(len(vec)):
        expr = expr + vec[i] * vec[i] * F.lit(float(m[i, i]))
        for j in range(i + 1, len(vec)):
            expr = expr + vec[i] * vec[j] * F.lit(float(2.0 * m[i, j]))
    return expr


@dataclass(frozen=True)
class OLSModel:
    target: str
    terms: tuple[Term, ...]
    intercept: bool
    coef: np.ndarray  # [b0?, b...]
    cov_params: np.ndarray
    n: float
    rss: float
    tss: float
    gram: Gram = field(repr=False)
    absorbed: int = 0  # parameters swept out before the fit (entity means of a within transform)

    # --- sizes -------------------------------------------------------------------------------
    @property
    def names(self) -> list[str]:
        return (["Intercept"] if self.intercept else []) + [t.name for t in self.terms]

    @property
    def n_params(self) -> int:
        return len(self.coef)

    @property
    def df_resid(self) -> float:
        return self.n - self.n_params - self.absorbed

    @property
    def df_model(self) -> float:
        return self.n_params - (1 if self.intercept else 0)

    @property
    def sigma2(self) -> float:
        return self.rss / self.df_resid if self.df_resid > 0 else float("nan")

    # --- metrics (MET1) --------------------------------------------------------------------------
    def metrics(self) -> dict[str, float | None]:
        n, p, rss, tss = self.n, self.n_params, self.rss, self.tss
        r2 = 1.0 - rss / tss if tss > 0 else float("nan")
        adj = 1.0 - (n - (1 if self.intercept else 0)) / self.df_resid * (1 - r2) if self.df_resid > 0 else float("nan")
        llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(rss / n) + 1.0) if rss > 0 else float("inf")
        aic = 2 * p - 2 * llf
        bic = p * math.log(n) - 2 * llf
        aicc = aic + 2 * p * (p + 1) / (n - p - 1) if n - p - 1 > 0 else None
        mdl = -llf + 0.5 * p * math.log(n)
        dfm = self.df_model
        f = ((tss - rss) / dfm) / (rss / self.df_resid) if dfm > 0 and self.df_resid > 0 and rss > 0 else float("nan")
        return {"n_obs": n, "r2": r2, "adj_r2": adj, "rmse": math.sqrt(rss / n), "rss": rss, "loglik": llf,
                "aic": aic, "bic": bic, "aicc": aicc, "mdl": mdl, "f_stat": f,
                "f_pvalue": tails.f_sf(f, dfm, self.df_resid) if math.isfinite(f) else None,
                "n_params": float(p)}

    def coefficients(self, spark, alpha: float = 0.05) -> DataFrame:
        """OLS3: term, coef, std_err, t, p_value, ci_low, ci_high."""
        se = np.sqrt(np.clip(np.diag(self.cov_params), 0, None))
        q = tails.t_ppf(1 - alpha / 2, self.df_resid) if self.df_resid > 0 else float("nan")
        rows = []
        for name, b, s in zip(self.names, self.coef, se):
            t = b / s if s > 0 else float("nan")
            rows.append((name, float(b), float(s), float(t), tails.t_sf2(t, self.df_resid), float(b - q * s),
                         float(b + q * s)))
        return small_frame(spark, rows, "term string, coef double, std_err double, t double, p_value double, "
                                        "ci_low double, ci_high double")

    def coef_and_intercept(self) -> tuple[dict[str, float], float]:
        d = dict(zip(self.names, map(float, self.coef)))
        return {k: v for k, v in d.items() if k != "Intercept"}, d.get("Intercept", 0.0)

    # --- prediction (OLS4/OLS5) ---------------------------------------------------------------------
    def predict_expr(self) -> Column:
        b = list(self.coef)
        expr = F.lit(float(b.pop(0))) if self.intercept else F.lit(0.0)
        for t, c in zip(self.terms, b):
            expr = expr + t.expr * F.lit(float(c))
        return expr

    def predict(self, df: DataFrame, keep: Sequence[str] = (), name: str = "yhat") -> DataFrame:
        check_columns(df, self.terms)
        return df.select(*keep, self.predict_expr().alias(name))

    def residuals(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Keyed y, fitted, resid on the model's complete cases."""
        check_columns(df, self.terms, self.target)
        cond = F.col(self.target).isNotNull()
        for t in self.terms:
            cond = cond & t.expr.isNotNull()
        yhat = self.predict_expr()
        return df.filter(cond).select(*keep, F.col(self.target).cast("double").alias("y"), yhat.alias("fitted"),
                                      (F.col(self.target) - yhat).alias("resid"))

    # --- collinearity (MET5, DIA6) -----------------------------------------------------------------
    def vif(self) -> dict[str, float]:
        """Uncentred VIF on the design without the intercept column (matches the reference)."""
        k = len(self.terms)
        if k == 0:
            return {}
        if k == 1:
            return {self.terms[0].name: 1.0}
        g = self.gram.sub([f"_t{i}" for i in range(k)])
        xtx = g.raw_xtx(intercept=False)
        inv = _safe_inv(xtx)
        return {t.name: float(inv[i, i] * xtx[i, i]) for i, t in enumerate(self.terms)}

    def condition_number(self) -> float:
        g = self.gram.sub([f"_t{i}" for i in range(len(self.terms))]) if self.terms else None
        xtx = g.raw_xtx(intercept=self.intercept) if g is not None else np.array([[self.n]])
        w = np.linalg.eigvalsh(xtx)
        return float(math.sqrt(w.max() / w.min())) if w.min() > 0 else float("inf")

    def leverage_expr(self) -> Column:
        """``x' (X'X)^-1 x``; with an intercept from the centred form ``1/n + (x - m)' S^-1 (x - m)``."""
        g = self.gram.sub([f"_t{i}" for i in range(len(self.terms))])
        if not self.intercept:
            return quad_form([t.expr for t in self.terms], _safe_inv(g.raw_xtx(intercept=False)))
        d = [t.expr - F.lit(float(m)) for t, m in zip(self.terms, g.means)]
        return F.lit(1.0 / self.n) + (quad_form(d, _safe_inv(g.cross)) if d else F.lit(0.0))


def solve_from_gram(g: Gram, x: Sequence[str], y: str, intercept: bool = True):
    """Coefficients, covariance, RSS and TSS for ``y ~ x`` from one Gram."""
    ix, iy = g.index(x), g.index([y])[0]
    n = g.n
    sxx = g.cross[np.ix_(ix, ix)]
    sxy = g.cross[ix, iy]
    syy = g.cross[iy, iy]
    mx, my = g.means[ix], g.means[iy]
    if intercept:
        inv = _safe_inv(sxx) if len(ix) else np.zeros((0, 0))
        beta = inv @ sxy if len(ix) else np.zeros(0)
        b0 = my - mx @ beta
        rss = max(float(syy - sxy @ beta), 0.0)
        tss = float(syy)
        p = len(ix) + 1
        s2 = rss / (n - p) if n > p else float("nan")
        v = inv @ mx
        cov = np.empty((p, p))
        cov[0, 0] = 1.0 / n + mx @ v
        cov[0, 1:] = cov[1:, 0] = -v
        cov[1:, 1:] = inv
        return np.concatenate([[b0], beta]), cov * s2, rss, tss
    xtx = sxx + n * np.outer(mx, mx)
    xty = sxy + n * mx * my
    inv = _safe_inv(xtx)
    beta = inv @ xty
    yty = syy + n * my * my
    rss = max(float(yty - xty @ beta), 0.0)
    p = len(ix)
    s2 = rss / (n - p) if n > p else float("nan")
    return beta, inv * s2, rss, float(yty)


def model_from_gram(g: Gram, target: str, terms: Sequence[Term], idx: Sequence[int] | None = None,
                    intercept: bool = True, absorbed: int = 0) -> OLSModel:
    """Fit a sub-model using Gram columns ``_t{i}`` (i in ``idx``) and ``_y``.

    ``absorbed`` degrees of freedom (e.g. one per entity after a within
    transform) are removed from the residual df, as in the dummy-variable fit.
    """
    idx = list(range(len(terms))) if idx is None else list(idx)
    x = [f"_t{i}" for i in idx]
    coef, cov, rss, tss = solve_from_gram(g, x, Y, intercept)
    p = len(idx) + (1 if intercept else 0)
    if absorbed and g.n - p - absorbed > 0:
        cov = cov * (g.n - p) / (g.n - p - absorbed)
    sub = g.sub([*x, Y])
    # re-key the sub Gram so the model's own terms are _t0.._tm
    sub = Gram(tuple([f"_t{j}" for j in range(len(idx))] + [Y]), sub.n, sub.means, sub.cross, sub.rows)
    return OLSModel(target, tuple(terms[i] for i in idx), intercept, coef, cov, g.n, rss, tss, sub, absorbed)


def design_frame(df: DataFrame, target: str | None, terms: Sequence[Term], extra: Sequence[str | Column] = ()) -> DataFrame:
    cols = [t.expr.cast("double").alias(f"_t{i}") for i, t in enumerate(terms)]
    if target is not None:
        cols.append(F.col(target).cast("double").alias(Y))
    return df.select(*extra, *cols)


def fit_ols(df: DataFrame, target: str, terms: Sequence[str | Term], intercept: bool = True,
            absorbed: int = 0) -> OLSModel:
    """OLS1/OLS2: ``target ~ terms``; rows with NULL in any used column are dropped."""
    ts = expand(terms, df)
    check_columns(df, ts, target)
    g = gram(design_frame(df, target, ts), [*[f"_t{i}" for i in range(len(ts))], Y])
    if g.n <= 0:
        raise ValueError("no complete rows to fit")
    return model_from_gram(g, target, ts, intercept=intercept, absorbed=absorbed)


def fit_design(df: DataFrame, target: str, columns: Sequence[str], add_intercept: bool | None = None) -> OLSModel:
    """OLS2: columns taken as they are; an all-ones column counts as the intercept; NULL is an error.

    One aggregate checks NULLs and constant-one columns for every column.
    """
    allc = [*columns, target]
    chk = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(allc)],
                 *[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
                 *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)]).first()
    bad = [c for i, c in enumerate(allc) if chk[f"n{i}"]]
    if bad:
        raise ValueError(f"design contains missing values in {bad}")
    const = [c for i, c in enumerate(columns) if chk[f"lo{i}"] == 1 and chk[f"hi{i}"] == 1]
    cols = [c for c in columns if c not in const]
    intercept = bool(const) if add_intercept is None else add_intercept or bool(const)
    return fit_ols(df, target, cols, intercept=intercept)


def mallows_cp(model: OLSModel, full: OLSModel) -> float:
    """MET3: ``RSS / s2_full + 2 p - n`` (p includes the intercept)."""
    s2 = full.sigma2
    if not (s2 > 0 and math.isfinite(s2)):  # the full model fits exactly: Cp is undefined
        return float("nan")
    return model.rss / s2 + 2.0 * model.n_params - model.n


def per_predictor(df: DataFrame, target: str, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """OLS8: one simple regression per predictor (and group) via ``unpivot`` + one ``groupBy``."""
    long = df.select(*by, F.col(target).cast("double").alias("_y"),
                     *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [*by, "_y"], list(features), "feature", "_x")
    pair = long.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    return pair.groupBy(*by, "feature").agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"), F.regr_r2("_y", "_x").alias("r2"))


def within_transform(df: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """OLS9: subtract entity means (fixed effects) - one aggregate joined back on the entity."""
    means = df.groupBy(entity).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns])
    return df.join(means, entity).withColumns({c: F.col(c) - F.col(f"_m_{c}") for c in columns}).drop(
        *[f"_m_{c}" for c in columns])
