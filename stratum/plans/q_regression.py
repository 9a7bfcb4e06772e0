"""Registered queries: OLS, diagnostics, metrics, selection, registry, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import absorb as AB
from ..operators import diagnostics as D
from ..operators import evaluate as E
from ..operators import ols as L
from ..operators import selection as S
from ..operators.clean import lag_by_entity
from ..operators.gram import gram
from ..operators.registry import ModelRegistry
from ..operators.terms import expand
from ..sources.tables import table
from ..frames import small_frame
from . import panels
from .catalog import query, rounded
from .sql_ols import _cell, moments_sql, selection_sql, subsets_sql, sweep_sql

PANEL_SQL = panels.CUSTOMER_YEAR_PANEL_SQL
Y, X, X2 = "total_value", "n_orders", "avg_value"
CANDS = ["n_orders", "avg_value", "max_value", "share_finished", "acctbal"]


def _r(x):
    return f"round({x}, 6) + 0.0"


def _panel(spark, sf):
    return panels.customer_year_panel(spark, sf)


def _chain_sql(xs, y, source=None):
    """CTEs that sweep all of ``xs``: ``e0_m`` and ``fit``."""
    k = len(xs)
    steps = [f"f{j + 1} AS ({sweep_sql('e0' if not j else f'f{j}', k, j)})" for j in range(k)]
    return f"{moments_sql(source or PANEL_SQL, xs, y)}, {', '.join(steps)}, fit AS (SELECT f{k}.*, e0_m.* FROM f{k}, e0_m)"


def _beta(i, k):
    return _cell(i, k)


def _b0(k):
    return f"(m_{k}" + "".join(f" - {_beta(i, k)} * m_{i}" for i in range(k)) + ")"


def _erfc_sql(x: str) -> str:
    """The same Chebyshev erfc approximation as the Spark side, written in SQL."""
    z = f"abs({x})"
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    from ..functions.tails import ERFC_COEFFS as coeffs

    poly = f"{coeffs[-1]}"
    for c in reversed(coeffs[1:-1]):
        poly = f"({c} + {t} * {poly})"
    poly = f"(-{z} * {z} + {coeffs[0]} + {t} * {poly})"
    ans = f"({t} * exp({poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def _t975_sql(nu: str) -> str:
    """t quantile 0.975 by the Cornish-Fisher series in 1/df (Abramowitz-Stegun 26.7.5), for large df."""
    z = 1.959963984540054
    g = [(z ** 3 + z) / 4, (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96,
         (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384,
         (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160]
    return f"({z!r} + " + " + ".join(f"{c!r} / power({nu}, {i + 1})" for i, c in enumerate(g)) + ")"


def _t_sf2_sql(t: str, nu: str) -> str:
    """Two-sided t tail by Wallace's normal deviate, for large df (relative error of order 1 / nu^2)."""
    z = f"((8.0 * {nu} + 1) / (8.0 * {nu} + 3) * sqrt({nu} * ln(1 + {t} * {t} / {nu})))"
    return _erfc_sql(f"({z} / sqrt(2.0))")


def _inference_sql(xs, names=None, fit="fit"):
    """Rows term, coef, std_err, t, p_value, ci_low, ci_high of the model that ``_chain_sql(xs, ...)`` fits."""
    k = len(xs)
    s2 = f"({_cell(k, k)} / (n - {k + 1}))"
    spread = " + ".join(f"{1 if i == j else 2} * m_{i} * m_{j} * (-{_cell(i, j)})" for i in range(k) for j in range(i, k))
    rows = [f"SELECT 'Intercept' AS term, {_b0(k)} AS b, sqrt({s2} * (1.0 / n + {spread})) AS se, n - {k + 1} AS nu FROM {fit}"]
    rows += [f"SELECT '{(names or xs)[i]}', {_beta(i, k)}, sqrt({s2} * (-{_cell(i, i)})), n - {k + 1} FROM {fit}" for i in range(k)]
    return f"""SELECT term, {_r("b")} AS coef, {_r("se")} AS std_err, {_r("b / se")} AS t, {_r(_t_sf2_sql("(b / se)", "nu"))} AS p_value,
       {_r(f"b - {_t975_sql('nu')} * se")} AS ci_low, {_r(f"b + {_t975_sql('nu')} * se")} AS ci_high
FROM ({" UNION ALL ".join(rows)})"""


# Closed-form simple regression (y ~ x) used by several oracles.
_SIMPLE = f"""s AS (SELECT CAST(regr_count({Y}, {X}) AS DOUBLE) AS n, regr_slope({Y}, {X}) AS b1, regr_intercept({Y}, {X}) AS b0,
                  regr_sxx({Y}, {X}) AS sxx, regr_syy({Y}, {X}) AS syy, regr_sxy({Y}, {X}) AS sxy,
                  regr_avgx({Y}, {X}) AS mx FROM {PANEL_SQL}),
e AS (SELECT *, syy - sxy * sxy / sxx AS rss, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM s)"""


# --- OLS1/OLS3 -------------------------------------------------------------------------------------------
@query("ols_simple_coefficients", oracle=f"""
WITH {_SIMPLE}
SELECT 'Intercept' AS term, {_r("b0")} AS coef, {_r("sqrt(s2 * (1.0 / n + mx * mx / sxx))")} AS std_err,
       {_r("b0 / sqrt(s2 * (1.0 / n + mx * mx / sxx))")} AS t FROM e
UNION ALL
SELECT '{X}', {_r("b1")}, {_r("sqrt(s2 / sxx)")}, {_r("b1 / sqrt(s2 / sxx)")} FROM e
""")
def ols_simple_coefficients(spark, sf):
    m = L.fit_ols(_panel(spark, sf), Y, [X])
    return rounded(m.coefficients(spark).select("term", "coef", "std_err", "t"))


@query("ols_four_predictors", oracle="WITH " + _chain_sql(["n_orders", "avg_value", "share_finished", "acctbal"], Y) + " " + " UNION ALL ".join(
    f"SELECT '{x}' AS term, round({_beta(i, 4)}, 4) + 0.0 AS coef, round(sqrt(-{_cell(i, i)} * {_cell(4, 4)} / (n - 5)), 4) + 0.0 AS std_err FROM fit"
    for i, x in enumerate(["n_orders", "avg_value", "share_finished", "acctbal"])) + f" UNION ALL SELECT 'r2', round(1 - fit.{_cell(4, 4)} / e0.{_cell(4, 4)}, 4) + 0.0, "
    f"round(sqrt(fit.{_cell(4, 4)} / n), 4) + 0.0 FROM fit, e0")
def ols_four_predictors(spark, sf):
    """OLS1/OLS3/MET1 with four predictors; the last row holds R2 and RMSE."""
    m = L.fit_ols(_panel(spark, sf), Y, ["n_orders", "avg_value", "share_finished", "acctbal"])
    metrics = m.metrics()
    last = small_frame(spark, [("r2", metrics["r2"], metrics["rmse"])], "term string, coef double, std_err double")
    return rounded(m.coefficients(spark).where("term <> 'Intercept'").select("term", "coef", "std_err").unionAll(last), 4)


_LI_X = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "date_part('epoch', l_shipdate)", "CAST(l_linenumber AS DOUBLE)", "l_quantity * l_discount"]


@query("ols_wide_large_offset", oracle="WITH " + _chain_sql(_LI_X, "date_part('epoch', l_shipdate) * 2.0 + l_extendedprice * 3.0 + l_tax * 1e8 + l_orderkey % 1000 * 1000.0", "lineitem") + " "
    + " UNION ALL ".join(f"SELECT 'x{i}' AS term, round({_beta(i, 7)}, 3) + 0.0 AS coef FROM fit" for i in (0, 1, 4, 5)))
def ols_wide_large_offset(spark, sf):
    """Eight columns (the wide Gram) with a ship date in epoch seconds: no digits may be lost to its mean."""
    at = F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("double")
    li = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("x0"), F.col("l_extendedprice").alias("x1"), F.col("l_discount").alias("x2"), F.col("l_tax").alias("x3"), at.alias("x4"),
        F.col("l_linenumber").cast("double").alias("x5"), (F.col("l_quantity") * F.col("l_discount")).alias("x6"),
        (at * 2.0 + F.col("l_extendedprice") * 3.0 + F.col("l_tax") * 1e8 + F.col("l_orderkey") % 1000 * 1000.0).alias("y"))
    m = L.fit_ols(li, "y", [f"x{i}" for i in range(7)])
    return rounded(m.coefficients(spark).where("term in ('x0', 'x1', 'x4', 'x5')").select("term", "coef"), 3)


_FULL_X = ["n_orders", "avg_value", "share_finished", "acctbal"]


@query("ols_coefficients_full", oracle=f"WITH {_chain_sql(_FULL_X, Y)} {_inference_sql(_FULL_X)}")
def ols_coefficients_full(spark, sf):
    """OLS3 with p-values and 95% intervals."""
    m = L.fit_ols(_panel(spark, sf), Y, ["n_orders", "avg_value", "share_finished", "acctbal"])
    return rounded(m.coefficients(spark))


# --- OLS2: a design matrix with its own column of ones ----------------------------------------------------------
@query("ols_design", oracle=f"WITH {_chain_sql([X, X2], Y)} {_inference_sql([X, X2])}")
def ols_design(spark, sf):
    """OLS2: columns as they are; the column of ones is taken as the intercept."""
    p = _panel(spark, sf).select(F.lit(1).alias("ones"), X, X2, Y)
    return rounded(L.fit_design(p, Y, ["ones", X, X2]).coefficients(spark))


# --- OLS4 -------------------------------------------------------------------------------------------------
@query("ols_residuals", oracle=f"""
WITH {_SIMPLE}
SELECT p.c_custkey, p.year, {_r(f"p.{Y}")} AS y, {_r(f"b0 + b1 * p.{X}")} AS fitted,
       {_r(f"p.{Y} - (b0 + b1 * p.{X})")} AS resid
FROM {PANEL_SQL} p, e
""")
def ols_residuals(spark, sf):
    p = _panel(spark, sf)
    return rounded(L.fit_ols(p, Y, [X]).residuals(p, keep=["c_custkey", "year"]))


# --- MET1 -------------------------------------------------------------------------------------------------------
_LLF = "(-n / 2.0 * (ln(2 * pi()) + ln(rss / n) + 1))"


@query("ols_fit_metrics", oracle=f"""
WITH {_SIMPLE}
SELECT n AS n_obs, {_r("1 - rss / syy")} AS r2, {_r("1 - (n - 1) / (n - 2) * (rss / syy)")} AS adj_r2,
       {_r("sqrt(rss / n)")} AS rmse, {_r(_LLF)} AS loglik, {_r(f"4 - 2 * {_LLF}")} AS aic,
       {_r(f"2 * ln(n) - 2 * {_LLF}")} AS bic, {_r(f"4 - 2 * {_LLF} + 12.0 / (n - 3)")} AS aicc,
       {_r(f"-{_LLF} + ln(n)")} AS mdl
FROM e
""")
def ols_fit_metrics(spark, sf):
    m = L.fit_ols(_panel(spark, sf), Y, [X]).metrics()
    keys = ["n_obs", "r2", "adj_r2", "rmse", "loglik", "aic", "bic", "aicc", "mdl"]
    return rounded(small_frame(spark, [tuple(float(m[k]) for k in keys)], ", ".join(f"{k} double" for k in keys)))


@query("ols_row_metrics", oracle=f"""
WITH {_SIMPLE}
SELECT {_r(f"avg(abs(p.{Y} - (b0 + b1 * p.{X})))")} AS mae,
       {_r(f"avg(abs(p.{Y} - (b0 + b1 * p.{X})) / abs(p.{Y}))")} AS mape,
       {_r(f"sqrt(avg((p.{Y} - (b0 + b1 * p.{X})) * (p.{Y} - (b0 + b1 * p.{X}))))")} AS rmse, CAST(count(*) AS DOUBLE) AS n
FROM {PANEL_SQL} p, e
""")
def ols_row_metrics(spark, sf):
    p = _panel(spark, sf)
    m = D.residual_metrics(L.fit_ols(p, Y, [X]), p)
    return rounded(small_frame(spark, [(m["mae"], m["mape"], m["rmse"], m["n"])],
                               "mae double, mape double, rmse double, n double"))


# --- OLS1 with two predictors: closed-form 2x2 solve --------------------------------------------------
_TWO = f"""c AS (SELECT count(*) AS n, var_pop({X}) AS a, covar_pop({X}, {X2}) AS b, var_pop({X2}) AS d,
                  covar_pop({X}, {Y}) AS u, covar_pop({X2}, {Y}) AS v, var_pop({Y}) AS w,
                  avg({X}) AS m1, avg({X2}) AS m2, avg({Y}) AS my FROM {PANEL_SQL}),
k AS (SELECT *, (d * u - b * v) / (a * d - b * b) AS b1, (a * v - b * u) / (a * d - b * b) AS b2 FROM c)"""


@query("ols_two_predictors", oracle=f"""
WITH {_TWO}
SELECT 'Intercept' AS term, {_r("my - b1 * m1 - b2 * m2")} AS coef FROM k
UNION ALL SELECT '{X}', {_r("b1")} FROM k
UNION ALL SELECT '{X2}', {_r("b2")} FROM k
""")
def ols_two_predictors(spark, sf):
    m = L.fit_ols(_panel(spark, sf), Y, [X, X2])
    return rounded(m.coefficients(spark).select("term", "coef"))


@query("mallows_cp", oracle=f"""
WITH {_TWO}, {_SIMPLE}
SELECT {_r("e.rss / ((k.n * (k.w - k.b1 * k.u - k.b2 * k.v)) / (k.n - 3)) + 4 - e.n")} AS cp FROM k, e
""")
def mallows_cp(spark, sf):
    p = _panel(spark, sf)
    full = L.fit_ols(p, Y, [X, X2])
    small = L.fit_ols(p, Y, [X])
    return rounded(small_frame(spark, [(L.mallows_cp(small, full),)], "cp double"))


# --- MET5 / DIA6 ------------------------------------------------------------------------------------------
@query("vif_two_predictors", oracle=f"""
WITH r AS (SELECT sum({X} * {X}) AS a, sum({X} * {X2}) AS b, sum({X2} * {X2}) AS d FROM {PANEL_SQL})
SELECT '{X}' AS term, {_r("a * d / (a * d - b * b)")} AS vif FROM r
UNION ALL SELECT '{X2}', {_r("a * d / (a * d - b * b)")} FROM r
""")
def vif_two_predictors(spark, sf):
    m = L.fit_ols(_panel(spark, sf), Y, [X, X2])
    return rounded(small_frame(spark, list(m.vif().items()), "term string, vif double"))


@query("condition_number", oracle=f"""
WITH r AS (SELECT CAST(count(*) AS DOUBLE) AS a, sum({X}) AS b, sum({X} * {X}) AS d FROM {PANEL_SQL}),
l AS (SELECT (a + d) / 2 + sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS l1,
             (a + d) / 2 - sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS l2 FROM r)
SELECT {_r("sqrt(l1 / l2)")} AS condition_number FROM l
""")
def condition_number(spark, sf):
    m = L.fit_ols(_panel(spark, sf), Y, [X])
    return rounded(small_frame(spark, [(m.condition_number(),)], "condition_number double"))


# --- DIA7/DIA8 ------------------------------------------------------------------------------------------------
@query("leverage_cooks", oracle=f"""
WITH {_SIMPLE},
r AS (SELECT p.c_custkey, p.year, p.{Y} - (b0 + b1 * p.{X}) AS resid,
             1.0 / n + (p.{X} - mx) * (p.{X} - mx) / sxx AS h, s2 FROM {PANEL_SQL} p, e)
SELECT c_custkey, year, {_r("h")} AS leverage, {_r("resid / sqrt(s2 * (1 - h))")} AS studentized,
       {_r("resid * resid / (s2 * (1 - h)) / 2.0 * h / (1 - h)")} AS cooks_d
FROM r
""")
def leverage_cooks(spark, sf):
    p = _panel(spark, sf)
    infl = D.influence(L.fit_ols(p, Y, [X]), p, keep=["c_custkey", "year"])
    return rounded(infl.select("c_custkey", "year", "leverage", "studentized", "cooks_d"))


# --- DIA1: Durbin-Watson over the event stream in time order ------------------------------------------
_EV = "(SELECT event_id, ts, value, CAST(hour(ts) AS DOUBLE) AS hr FROM events)"


@query("durbin_watson", oracle=f"""
WITH s AS (SELECT regr_slope(value, hr) AS b1, regr_intercept(value, hr) AS b0 FROM {_EV}),
r AS (SELECT event_id, ts, value - (b0 + b1 * hr) AS e FROM {_EV}, s),
d AS (SELECT e, e - lag(e) OVER (ORDER BY ts, event_id) AS de FROM r)
SELECT {_r("sum(de * de) / sum(e * e)")} AS durbin_watson FROM d
""")
def durbin_watson(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "value", F.hour("ts").cast("double").alias("hr"))
    m = L.fit_ols(ev, "value", ["hr"])
    r = m.residuals(ev, keep=["ts", "event_id"])
    return rounded(small_frame(spark, [(D.durbin_watson(r, "resid", ["ts", "event_id"]),)], "durbin_watson double"))


# --- DIA2 / DIA4 ---------------------------------------------------------------------------------------------------
@query("jarque_bera", oracle=f"""
WITH {_SIMPLE},
r AS (SELECT p.{Y} - (b0 + b1 * p.{X}) AS e FROM {PANEL_SQL} p, e),
m AS (SELECT count(*) AS n, avg(e) AS mu FROM r),
c AS (SELECT n, avg(power(e - mu, 2)) AS m2, avg(power(e - mu, 3)) AS m3, avg(power(e - mu, 4)) AS m4 FROM r, m GROUP BY n)
SELECT {_r("n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0)")} AS jarque_bera FROM c
""")
def jarque_bera(spark, sf):
    p = _panel(spark, sf)
    m = L.fit_ols(p, Y, [X])
    infl = D.influence(m, p)
    mom = infl.agg(F.skewness("resid").alias("s"), F.kurtosis("resid").alias("k")).first()
    jb = m.n / 6.0 * (mom["s"] ** 2 + mom["k"] ** 2 / 4.0)
    return rounded(small_frame(spark, [(jb,)], "jarque_bera double"))


@query("breusch_pagan", oracle=f"""
WITH {_SIMPLE},
r AS (SELECT p.{X} AS x, power(p.{Y} - (b0 + b1 * p.{X}), 2) AS e2 FROM {PANEL_SQL} p, e)
SELECT {_r("count(*) * power(corr(e2, x), 2)")} AS breusch_pagan FROM r
""")
def breusch_pagan(spark, sf):
    p = _panel(spark, sf)
    bp, _, _, _ = D.het_tests(L.fit_ols(p, Y, [X]), p)
    return rounded(small_frame(spark, [(bp,)], "breusch_pagan double"))


_LM = """r AS (SELECT CAST(p.{x} AS DOUBLE) AS x, CAST(p.{x} AS DOUBLE) * p.{x} AS q, p.{y} - (b0 + b1 * p.{x}) AS e, p.c_custkey, p.year FROM {src} p, e),
c AS (SELECT CAST(count(*) AS DOUBLE) AS n, corr(e * e, x) AS rx, corr(e * e, q) AS rq, corr(x, q) AS xq, avg(e) AS mu FROM r),
lm AS (SELECT n * rx * rx AS bp, n * (rx * rx + rq * rq - 2 * rx * rq * xq) / (1 - xq * xq) AS white FROM c),
m AS (SELECT n, avg(power(e - mu, 2)) AS m2, avg(power(e - mu, 3)) AS m3, avg(power(e - mu, 4)) AS m4 FROM r, c GROUP BY n),
jb AS (SELECT n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0) AS jb FROM m),
d AS (SELECT e, e - lag(e) OVER (ORDER BY c_custkey, year) AS de FROM r),
dw AS (SELECT sum(de * de) / sum(e * e) AS dw FROM d)""".format(x=X, y=Y, src=PANEL_SQL)
_FAIL = "CASE WHEN {0} < 0.05 THEN 'FAIL' ELSE 'OK' END"


@query("assumption_verdicts", oracle=f"""
WITH {_SIMPLE}, {_LM},
v AS (SELECT 'jarque_bera' AS test, jb AS stat, exp(-jb / 2) AS p FROM jb
      UNION ALL SELECT 'breusch_pagan', bp, {_erfc_sql("sqrt(bp / 2)")} FROM lm
      UNION ALL SELECT 'white', white, exp(-white / 2) FROM lm)
SELECT 'simple' AS model, test AS "check", {_r("stat")} AS value, NULL AS verdict FROM v
UNION ALL SELECT 'simple', test || '_pvalue', {_r("p")}, {_FAIL.format("p")} FROM v
UNION ALL SELECT 'simple', 'durbin_watson', {_r("dw")}, CASE WHEN dw BETWEEN 1.5 AND 2.5 THEN 'OK' ELSE 'FAIL' END FROM dw
""")
def assumption_verdicts(spark, sf):
    """DIA5/DIA9/DIA10: tests of one predictor's model, whose tails have closed forms, with verdicts."""
    p = panels.materialize(_panel(spark, sf))
    checks = D.assumption_checks(L.fit_ols(p, Y, [X]), p, order=["c_custkey", "year"])
    shown = ["jarque_bera", "breusch_pagan", "white", "jarque_bera_pvalue", "breusch_pagan_pvalue", "white_pvalue", "durbin_watson"]
    return rounded(D.assumption_table(spark, {"simple": checks}).where(F.col("check").isin(shown)))


@query("assumption_table")
def assumption_table(spark, sf):
    """DIA9/DIA10: every check for two models, with verdicts (normal tails on the driver: rows-only)."""
    p = panels.materialize(_panel(spark, sf))
    checks = {}
    for name, rhs in {"simple": [X], "multi": [X, X2, "share_finished"]}.items():
        checks[name] = D.assumption_checks(L.fit_ols(p, Y, rhs), p, order=["c_custkey", "year"])
    return rounded(D.assumption_table(spark, checks))


_AD_A2 = "(-n - s / n)"
_AD_A2A = f"({_AD_A2} * (1 + 0.75 / n + 2.25 / (n * n)))"
_AD_P = (f"CASE WHEN {_AD_A2A} < 0.2 THEN 1 - exp(-13.436 + 101.14 * {_AD_A2A} - 223.73 * {_AD_A2A} * {_AD_A2A}) "
         f"WHEN {_AD_A2A} < 0.34 THEN 1 - exp(-8.318 + 42.796 * {_AD_A2A} - 59.938 * {_AD_A2A} * {_AD_A2A}) "
         f"WHEN {_AD_A2A} < 0.6 THEN exp(0.9177 - 4.279 * {_AD_A2A} - 1.38 * {_AD_A2A} * {_AD_A2A}) "
         f"WHEN {_AD_A2A} <= 13 THEN exp(1.2937 - 5.709 * {_AD_A2A} + 0.0186 * {_AD_A2A} * {_AD_A2A}) ELSE 0.0 END")


@query("anderson_darling", oracle=f"""
WITH {_SIMPLE},
r AS (SELECT p.{Y} - (b0 + b1 * p.{X}) AS e FROM {PANEL_SQL} p, e),
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(e) AS mu, stddev_samp(e) AS sd FROM r),
z AS (SELECT row_number() OVER (ORDER BY r.e) AS i, m.n,
             0.5 * {_erfc_sql("(-(r.e - m.mu) / m.sd / sqrt(2.0))")} AS cdf, 0.5 * {_erfc_sql("((r.e - m.mu) / m.sd / sqrt(2.0))")} AS above FROM r, m),
t AS (SELECT max(n) AS n, sum((2 * i - 1) * ln(greatest(cdf, 1e-300)) + (2 * n + 1 - 2 * i) * ln(greatest(above, 1e-300)))
             AS s FROM z)
SELECT {_r(_AD_A2)} AS statistic,
       {_r(_AD_P)} AS p_value
FROM t
""")
def anderson_darling(spark, sf):
    """DIA3 on the simple model's residuals (rank sums over range partitions)."""
    p = _panel(spark, sf)
    r = L.fit_ols(p, Y, [X]).residuals(p)
    a2, pv = D.anderson_darling(r, "resid")
    return rounded(small_frame(spark, [(a2, pv)], "statistic double, p_value double"))


# --- OLS8 ---------------------------------------------------------------------------------------------------------
@query("per_predictor_ols", oracle=" UNION ALL ".join(
    f"SELECT c_mktsegment, '{c}' AS feature, CAST(regr_count({Y}, {c}) AS BIGINT) AS n, {_r(f'regr_slope({Y}, {c})')} AS slope, "
    f"{_r(f'regr_intercept({Y}, {c})')} AS intercept, {_r(f'regr_r2({Y}, {c})')} AS r2 "
    f"FROM {PANEL_SQL} GROUP BY c_mktsegment" for c in CANDS))
def per_predictor_ols(spark, sf):
    return rounded(L.per_predictor(_panel(spark, sf), Y, CANDS, by=["c_mktsegment"]))


# --- MET2: K-fold CV from one grouped Gram --------------------------------------------------------------------------
_FOLD = "CAST(floor(CAST(('0x' || substr(md5('7|' || c_custkey || '|' || year), 1, 8)) AS BIGINT) / 4294967296.0 * 5) AS INTEGER)"


@query("cv_rmse", oracle=f"""
WITH d AS (SELECT {_FOLD} AS fold, {X} AS x, {Y} AS y FROM {PANEL_SQL}),
f AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy,
             sum(y * y) AS syy FROM d GROUP BY fold),
t AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM f),
m AS (SELECT f.*, (t.n - f.n) AS tn, (t.sx - f.sx) AS tsx, (t.sy - f.sy) AS tsy, (t.sxx - f.sxx) AS tsxx,
             (t.sxy - f.sxy) AS tsxy FROM f, t),
b AS (SELECT *, (tn * tsxy - tsx * tsy) / (tn * tsxx - tsx * tsx) AS b1 FROM m),
c AS (SELECT *, (tsy - b1 * tsx) / tn AS b0 FROM b)
SELECT fold, {_r("sqrt((syy - 2 * b0 * sy - 2 * b1 * sxy + b0 * b0 * n + 2 * b0 * b1 * sx + b1 * b1 * sxx) / n)")} AS rmse
FROM c
""")
def cv_rmse(spark, sf):
    p = _panel(spark, sf)
    sel = S.Selector(p, Y, [], [X], cv_folds=5, seed=7, key=["c_custkey", "year"])
    scores = sel.cv.rmse_scores([0])
    return rounded(small_frame(spark, list(enumerate(scores)), "fold int, rmse double"))


_PLACE = f"(SELECT *, row_number() OVER (ORDER BY c_custkey, year) - 1 AS place, count(*) OVER () AS total FROM {PANEL_SQL})"


@query("cv_rmse_contiguous", oracle=f"""
WITH d AS (SELECT {X} AS x, {Y} AS y, CASE WHEN place < (total % 5) * (total // 5 + 1) THEN place // (total // 5 + 1)
                  ELSE total % 5 + (place - (total % 5) * (total // 5 + 1)) // (total // 5) END AS fold FROM {_PLACE}),
k AS (SELECT unnest(range(5)) AS fold),
t AS (SELECT k.fold, regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM k JOIN d ON d.fold <> k.fold GROUP BY k.fold)
SELECT CAST(fold AS INTEGER) AS fold, {_r("sqrt(avg((y - b0 - b1 * x) * (y - b0 - b1 * x)))")} AS rmse FROM d JOIN t USING (fold) GROUP BY fold
""")
def cv_rmse_contiguous(spark, sf):
    """MET2 without shuffling: five runs of rows in key order."""
    sel = S.Selector(_panel(spark, sf), Y, [], [X], cv_folds=5, key=["c_custkey", "year"], shuffle=False)
    return rounded(small_frame(spark, list(enumerate(sel.cv.rmse_scores([0]))), "fold int, rmse double"))


@query("scale_location", oracle=f"""
WITH {_SIMPLE},
r AS (SELECT c_custkey, year, b0 + b1 * p.{X} AS fitted, p.{Y} - (b0 + b1 * p.{X}) AS resid,
             1.0 / n + (p.{X} - mx) * (p.{X} - mx) / sxx AS h, s2 FROM {PANEL_SQL} p, e)
SELECT c_custkey, year, round(fitted, 4) + 0.0 AS fitted, round(resid, 4) + 0.0 AS resid,
       {_r("sqrt(abs(resid / sqrt(s2 * (1 - h))))")} AS scale FROM r
""")
def scale_location(spark, sf):
    """CHD7: residual against fitted, and the scale-location ordinate."""
    p = _panel(spark, sf)
    infl = D.influence(L.fit_ols(p, Y, [X]), p, keep=["c_custkey", "year"])
    return infl.select("c_custkey", "year", (F.round("fitted", 4) + 0.0).alias("fitted"), (F.round("resid", 4) + 0.0).alias("resid"),
                       (F.round(F.sqrt(F.abs("studentized")), 6) + 0.0).alias("scale"))


# --- SEL1-SEL4, SEL7 ------------------------------------------------------------------------------------------------------
@query("forward_selection", oracle=selection_sql(PANEL_SQL, CANDS, Y, [("forward", "aic", 1.0)], False, 3))
def forward_selection(spark, sf):
    sel = S.Selector(_panel(spark, sf), Y, [], CANDS)
    return rounded(sel.path("forward", "aic", 1.0, label="forward_aic").to_frame(spark), 3)


_GRID = [(d, c, {"mdl": 0.5, "adj_r2": 0.001}.get(c, 1.0)) for d in S.DIRECTIONS for c in S.CRITERIA]


@query("selection_paths", oracle=selection_sql(PANEL_SQL, CANDS, Y, _GRID, True, 3))
def selection_paths(spark, sf):
    """SEL1-SEL4: the best model of every direction and criterion."""
    sel = S.Selector(_panel(spark, sf), Y, [], CANDS)
    return rounded(S.collect_paths(sel.grid(), spark, best_only=True), 3)


@query("selection_grid")
def selection_grid(spark, sf):
    sel = S.Selector(_panel(spark, sf), Y, [], CANDS, cv_folds=5, seed=0, key=["c_custkey", "year"])
    return rounded(S.collect_paths(sel.grid(), spark, best_only=True))


_N = len(CANDS)


def _subset_coefs_sql():
    """CTEs of all subsets of the candidates, then ``coefs(mask, term, b)``."""
    parts = []
    for mask in range(1, 1 << _N):
        on = [i for i in range(_N) if mask >> i & 1]
        b0 = f"m_{_N}" + "".join(f" - {_cell(i, _N)} * m_{i}" for i in on)
        parts.append(f"SELECT {mask} AS mask, 'Intercept' AS term, {b0} AS b FROM e{mask}, e0_m")
        parts += [f"SELECT {mask}, '{CANDS[i]}', {_cell(i, _N)} FROM e{mask}" for i in on]
    return f"{moments_sql(PANEL_SQL, CANDS, Y)}, {subsets_sql(_N)}, coefs AS ({' UNION ALL '.join(parts)})"


def _mask_sql(rhs):
    return "(" + " + ".join(f"CASE WHEN list_contains(string_split({rhs}, ' + '), '{c}') THEN {1 << i} ELSE 0 END" for i, c in enumerate(CANDS)) + ")"


_TWO_PATHS = [("forward", "aic", 1.0), ("forward", "bic", 1.0)]


@query("coefficient_compare", oracle=f"""
WITH {_subset_coefs_sql()},
best AS (SELECT label, {_mask_sql("rhs")} AS mask FROM ({selection_sql(PANEL_SQL, CANDS, Y, _TWO_PATHS, True, 3)}))
SELECT label, term, {_r("b")} AS coef, {_r("abs(b)")} AS abs_coef FROM best JOIN coefs USING (mask)
""")
def coefficient_compare(spark, sf):
    sel = S.Selector(_panel(spark, sf), Y, [], CANDS)
    paths = [sel.path("forward", c, 1.0 if c != "adj_r2" else 0.001, label=f"forward_{c}") for c in ("aic", "bic")]
    return rounded(S.coefficient_table(paths, spark))


@query("selection_in_cv")
def selection_in_cv(spark, sf):
    return rounded(S.selection_in_cv(_panel(spark, sf), Y, CANDS, k=5, seed=0, key=["c_custkey", "year"]))


_PRODUCTS = [(X, X2), (X, "share_finished"), (X2, "acctbal")]


def _screen_sql(a, b):
    xs = [X, X2, f"({a} * {b})"]
    aic = lambda k, rss: f"(n * ln({rss} / n) + 2 * ({k} + 1))"
    plain = f"(SELECT {aic(2, _cell(3, 3))} AS v FROM f2, e0_m)"
    exact = f"{_cell(3, 3)} < 1e-12 * (SELECT {_cell(3, 3)} FROM e0)"  # no residual: neither a tail nor a likelihood
    return f"""SELECT '{a}:{b}' AS term, coef, CASE WHEN NOT exact THEN p_value END AS p_value, CASE WHEN NOT exact THEN {_r("aic - plain")} END AS delta_aic FROM (
WITH {_chain_sql(xs, Y)}, plain AS {plain}, found AS ({_inference_sql(xs, [X, X2, "product"])})
SELECT coef, p_value, {aic(3, f"greatest({_cell(3, 3)}, 0)")} AS aic, plain.v AS plain, {exact} AS exact FROM found, fit, plain WHERE term = 'product')"""


@query("interaction_screen", oracle=" UNION ALL ".join(_screen_sql(a, b) for a, b in _PRODUCTS))
def interaction_screen(spark, sf):
    p = _panel(spark, sf)
    sel = S.Selector(p, Y, [X, X2], [])
    rows = sel.interaction_screen([X, X2], [(X, X2), (X, "share_finished"), (X2, "acctbal")], p)
    return rounded(small_frame(spark, [(r["term"], r["coef"], r["p_value"], r["delta_aic"]) for r in rows],
                               "term string, coef double, p_value double, delta_aic double"))


# --- REG1/REG3: best models of several paths, registered under their own names -------------------------------------------
_REG_PATHS = [("forward", "aic", 1.0), ("backward", "bic", 1.0), ("stepwise", "mdl", 1.0)]


@query("registry_paths", oracle=f"""
SELECT 'sel_' || label AS model, direction, criterion, step, n_terms, CASE criterion WHEN 'aic' THEN aic WHEN 'bic' THEN bic ELSE mdl END AS value,
       aic, bic, adj_r2, rmse
FROM ({selection_sql(PANEL_SQL, CANDS, Y, _REG_PATHS, True, 3)})
""")
def registry_paths(spark, sf):
    p = _panel(spark, sf)
    reg = ModelRegistry()
    reg.fit(p, Y, [X], name="plain")
    reg.register_best_paths([S.Selector(p, Y, [], CANDS).path(d, c, t) for d, c, t in _REG_PATHS])
    reg.remove("plain")
    return rounded(reg.path_table(spark), 3)


_TRAIN = f"(SELECT * FROM {PANEL_SQL} WHERE year < 2000)"


def _entry_sql(name, xs):
    k = len(xs)
    fit = f"{_b0(k)}" + "".join(f" + {_beta(i, k)} * {x}" for i, x in enumerate(xs))
    rss = f"max({_cell(k, k)})"
    llf = f"(-max(n) / 2 * (ln(2 * pi()) + ln({rss} / max(n)) + 1))"
    early, late = "FILTER (WHERE year < 2000)", "FILTER (WHERE year >= 2000)"
    err = f"({Y} - ({fit}))"
    return f"""SELECT '{name}' AS model, max(n) AS n_obs, {_r(f"1 - {rss} / max(tss)")} AS r2,
       {_r(f"1 - (max(n) - 1) / (max(n) - {k + 1}) * {rss} / max(tss)")} AS adj_r2, {_r(f"sqrt({rss} / max(n))")} AS rmse,
       {_r(f"avg(abs({err})) {early}")} AS mae, {_r(f"2 * {k + 1} - 2 * {llf}")} AS aic, {_r(f"{k + 1} * ln(max(n)) - 2 * {llf}")} AS bic,
       {_r(f"sqrt(avg({err} * {err}) {late})")} AS holdout_rmse, {_r(f"1 - avg({err} * {err}) {late} / var_pop({Y}) {late}")} AS holdout_r2
FROM (WITH {_chain_sql(xs, Y, _TRAIN)} SELECT fit.*, e0.{_cell(k, k)} AS tss FROM fit, e0), {PANEL_SQL}"""


@query("registry_holdout", oracle=" UNION ALL ".join(_entry_sql(n, xs) for n, xs in (("one", [X]), ("two", [X, X2]), ("all", CANDS))))
def registry_holdout(spark, sf):
    """REG1/REG4: three models fitted before 2000, scored from 2000 on, in one table."""
    p = panels.materialize(_panel(spark, sf))
    reg = ModelRegistry()
    for name, rhs in (("one", [X]), ("two", [X, X2]), ("all", CANDS)):
        reg.fit(p.filter(F.col("year") < 2000), Y, rhs, name=name)
    reg.evaluate_all(p.filter(F.col("year") >= 2000), "holdout")
    return rounded(reg.compare(spark, sort_by="holdout_rmse").drop("rhs"))


# --- REG1-REG4 -------------------------------------------------------------------------------------------------------------
@query("registry_compare")
def registry_compare(spark, sf):
    p = panels.materialize(_panel(spark, sf))
    train = p.filter(F.col("year") < 2000)
    test = p.filter(F.col("year") >= 2000)
    reg = ModelRegistry()
    reg.fit(train, Y, [X])
    reg.fit(train, Y, [X, X2], name="two")
    reg.fit(train, Y, [X, X2], name="two_trimmed", cooks_threshold="4/n")
    reg.fit_stepwise(train, Y, [], CANDS, name="stepwise_bic", direction="stepwise", criterion="bic")
    reg.evaluate_all(test, "holdout")
    return rounded(reg.compare(spark, sort_by="aic").drop("rhs"))


def _assumptions_sql(name, x):
    """The assumption table's row of ``Y ~ x``, whose tails and eigenvalues have closed forms."""
    return f"""SELECT * FROM (WITH s AS (SELECT CAST(regr_count({Y}, {x}) AS DOUBLE) AS n, regr_slope({Y}, {x}) AS b1, regr_intercept({Y}, {x}) AS b0,
                  regr_sxx({Y}, {x}) AS sxx, regr_syy({Y}, {x}) AS syy, regr_sxy({Y}, {x}) AS sxy, regr_avgx({Y}, {x}) AS mx FROM {PANEL_SQL}),
e AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2, sxx + n * mx * mx AS sq FROM s),
r AS (SELECT CAST(p.{x} AS DOUBLE) AS x, CAST(p.{x} AS DOUBLE) * p.{x} AS q, p.{Y} - (b0 + b1 * p.{x}) AS e,
             1.0 / n + (p.{x} - mx) * (p.{x} - mx) / sxx AS h, s2, c_custkey, year FROM {PANEL_SQL} p, e),
c AS (SELECT CAST(count(*) AS DOUBLE) AS n, corr(e * e, x) AS rx, corr(e * e, q) AS rq, corr(x, q) AS xq, avg(e) AS mu, stddev_samp(e) AS sd,
             max(h) AS max_h, max(e * e / (s2 * (1 - h)) / 2.0 * h / (1 - h)) AS max_d FROM r),
m AS (SELECT avg(power(e - mu, 2)) AS m2, avg(power(e - mu, 3)) AS m3, avg(power(e - mu, 4)) AS m4 FROM r, c),
d AS (SELECT e, e - lag(e) OVER (ORDER BY c_custkey, year) AS de FROM r),
dw AS (SELECT sum(de * de) / sum(e * e) AS dw FROM d),
z AS (SELECT row_number() OVER (ORDER BY r.e) AS i, n, 0.5 * {_erfc_sql("(-(r.e - mu) / sd / sqrt(2.0))")} AS cdf,
             0.5 * {_erfc_sql("((r.e - mu) / sd / sqrt(2.0))")} AS above FROM r, c),
t AS (SELECT max(n) AS n, sum((2 * i - 1) * ln(greatest(cdf, 1e-300)) + (2 * n + 1 - 2 * i) * ln(greatest(above, 1e-300))) AS s FROM z),
ad AS (SELECT {_AD_P} AS normal FROM t),
l AS (SELECT n + sq AS tr, sqrt((n - sq) * (n - sq) + 4 * n * mx * n * mx) AS gap FROM e)
SELECT '{name}' AS model, {_r("dw")} AS durbin_watson, {_r("exp(-n / 12.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0))")} AS jarque_bera_pvalue,
       {_r("normal")} AS normality_pvalue, {_r(_erfc_sql("sqrt(n * rx * rx / 2)"))} AS breusch_pagan_pvalue,
       {_r("exp(-n * (rx * rx + rq * rq - 2 * rx * rq * xq) / (1 - xq * xq) / 2)")} AS white_pvalue,
       round(sqrt((tr + gap) / (tr - gap)), 3) + 0.0 AS condition_number, 1.0::DOUBLE AS max_vif, {_r("max_h")} AS max_leverage, {_r("max_d")} AS max_cooks_d
FROM c, m, dw, ad, l)"""


@query("registry_assumptions", oracle=f"{_assumptions_sql('orders', X)} UNION ALL {_assumptions_sql('standing', 'acctbal')}")
def registry_assumptions(spark, sf):
    """REG1/DIA9: the assumption table of two of three registered models."""
    p = panels.materialize(_panel(spark, sf))
    reg = ModelRegistry()
    reg.fit(p, Y, [X], name="orders")
    reg.fit(p, Y, ["acctbal"], name="standing")
    reg.fit(p, Y, CANDS, name="all")
    found = reg.assumptions_table(spark, ["orders", "standing"], order=["c_custkey", "year"])
    return rounded(found.withColumn("condition_number", F.round("condition_number", 3)))


@query("cooks_trimmed_refit", oracle=f"""
WITH {_SIMPLE},
r AS (SELECT p.{X} AS x, p.{Y} AS y, (p.{Y} - (b0 + b1 * p.{X})) AS resid,
             1.0 / n + (p.{X} - mx) * (p.{X} - mx) / sxx AS h, s2, n FROM {PANEL_SQL} p, e),
k AS (SELECT x, y FROM r WHERE resid * resid / (s2 * (1 - h)) / 2.0 * h / (1 - h) <= 4.0 / n)
SELECT 'Intercept' AS term, {_r("regr_intercept(y, x)")} AS coef, count(*) AS n_kept FROM k
UNION ALL SELECT '{X}', {_r("regr_slope(y, x)")}, count(*) FROM k
""")
def cooks_trimmed_refit(spark, sf):
    p = _panel(spark, sf)
    m = L.fit_ols(p, Y, [X])
    trimmed, _ = D.refit_without(m, p)
    rows = [(n, float(b), int(trimmed.n)) for n, b in zip(trimmed.names, trimmed.coef)]
    return rounded(small_frame(spark, rows, "term string, coef double, n_kept long"))


# --- EVA1/EVA6: hash split hold-out --------------------------------------------------------------------------------------
_U42 = "CAST(('0x' || substr(md5('42|' || c_custkey || '|' || year), 1, 8)) AS BIGINT) / 4294967296.0"


@query("holdout_eval", oracle=f"""
WITH tr AS (SELECT regr_slope({Y}, {X}) AS b1, regr_intercept({Y}, {X}) AS b0 FROM {PANEL_SQL} WHERE {_U42} >= 0.2),
te AS (SELECT {Y} AS y, {Y} - (b0 + b1 * {X}) AS e FROM {PANEL_SQL}, tr WHERE {_U42} < 0.2)
SELECT 'simple' AS model, count(*) AS n, {_r("sqrt(avg(e * e))")} AS rmse, {_r("avg(abs(e))")} AS mae,
       {_r("1 - avg(e * e) / var_pop(y)")} AS r2 FROM te
""")
def holdout_eval(spark, sf):
    p = _panel(spark, sf)
    train, test = E.split(p, ["c_custkey", "year"], 0.2, 42)
    return rounded(E.evaluate({"simple": L.fit_ols(train, Y, [X])}, test))


@query("eval_by_year", oracle=f"""
WITH tr AS (SELECT regr_slope({Y}, {X}) AS b1, regr_intercept({Y}, {X}) AS b0 FROM {PANEL_SQL} WHERE year = 1996),
te AS (SELECT year, {Y} AS y, {Y} - (b0 + b1 * {X}) AS e FROM {PANEL_SQL}, tr)
SELECT year, 'simple' AS model, count(*) AS n, {_r("sqrt(avg(e * e))")} AS rmse, {_r("avg(abs(e))")} AS mae,
       {_r("1 - avg(e * e) / var_pop(y)")} AS r2 FROM te GROUP BY year
""")
def eval_by_year(spark, sf):
    p = _panel(spark, sf)
    m = L.fit_ols(p.filter(F.col("year") == 1996), Y, [X])
    return rounded(E.evaluate_by({"simple": m}, p, "year"))


_CROSS = f"""WITH tr AS (SELECT year AS trained, regr_slope({Y}, {X}) AS b1, regr_intercept({Y}, {X}) AS b0 FROM {PANEL_SQL} GROUP BY year),
te AS (SELECT trained, year, {Y} AS y, {Y} - (b0 + b1 * {X}) AS e FROM {PANEL_SQL}, tr),
m AS (SELECT trained, year, count(*) AS n, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - avg(e * e) / var_pop(y) AS r2 FROM te GROUP BY trained, year)"""


def _models_by_year(p):
    grams = gram(p.select("year", F.col(X).cast("double").alias("_t0"), F.col(Y).cast("double").alias("_y")), ["_t0", "_y"], by="year")
    terms = expand([X], p)
    return {year: L.model_from_gram(g, Y, terms) for year, g in sorted(grams.items())}  # a model a year from one pass


@query("cross_period_matrix", oracle=f"""{_CROSS}
SELECT CAST(trained AS VARCHAR) AS trained_on, year, n, {_r("rmse")} AS rmse, {_r("mae")} AS mae, {_r("r2")} AS r2 FROM m""")
def cross_period_matrix(spark, sf):
    """EVA6: the model of each year scored on every year."""
    p = panels.materialize(_panel(spark, sf))
    return rounded(E.cross_period(_models_by_year(p), p, "year"))


@query("eval_mean_over_years", oracle=f"""{_CROSS}
SELECT CAST(trained AS VARCHAR) AS trained_on, count(*) AS n_periods, {_r("avg(rmse)")} AS mean_rmse, {_r("avg(mae)")} AS mean_mae,
       {_r("avg(r2)")} AS mean_r2 FROM m GROUP BY trained""")
def eval_mean_over_years(spark, sf):
    """EVA2: each year's model, mean of its metrics over all years."""
    p = panels.materialize(_panel(spark, sf))
    return rounded(E.mean_over_periods(E.cross_period(_models_by_year(p), p, "year"), "trained_on"))


# --- EVA3: paired bootstrap of hold-out metrics ------------------------------------------------------------------------
def _poisson_sql(u):
    from ..functions.hashrand import POISSON1_CDF

    return "(" + " + ".join(f"CASE WHEN {u} >= {p!r} THEN 1 ELSE 0 END" for p in POISSON1_CDF) + ")"


_UB = "CAST(('0x' || substr(md5('3:' || r || '|' || c_custkey || '|' || year), 1, 8)) AS BIGINT) / 4294967296.0"


@query("bootstrap_ci", oracle=f"""
WITH {_SIMPLE},
pr AS (SELECT c_custkey, year, {Y} AS y, b0 + b1 * {X} AS p FROM {PANEL_SQL}, e),
rep AS (SELECT pr.*, {_poisson_sql(_UB)} AS w, r FROM pr, range(0, 200) t(r)),
per AS (SELECT r, sqrt(sum(w * (y - p) * (y - p)) / sum(w)) AS rmse, sum(w * abs(y - p)) / sum(w) AS mae,
               1 - sum(w * (y - p) * (y - p)) / (sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w)) AS r2
        FROM rep WHERE w > 0 GROUP BY r)
SELECT 'rmse' AS metric, {_r("quantile_cont(rmse, 0.025)")} AS ci_low, {_r("quantile_cont(rmse, 0.5)")} AS median,
       {_r("quantile_cont(rmse, 0.975)")} AS ci_high FROM per
UNION ALL SELECT 'mae', {_r("quantile_cont(mae, 0.025)")}, {_r("quantile_cont(mae, 0.5)")},
       {_r("quantile_cont(mae, 0.975)")} FROM per
UNION ALL SELECT 'r2', {_r("quantile_cont(r2, 0.025)")}, {_r("quantile_cont(r2, 0.5)")},
       {_r("quantile_cont(r2, 0.975)")} FROM per
""")
def bootstrap_ci(spark, sf):
    p = panels.materialize(_panel(spark, sf))
    m = L.fit_ols(p, Y, [X])
    return rounded(E.bootstrap_metrics(m, p, ["c_custkey", "year"], n_boot=200, seed=3))


_UR = "CAST(('0x' || substr(md5('1:' || r || '|' || c_custkey || '|' || year), 1, 8)) AS BIGINT) / 4294967296.0"


@query("bootstrap_refit", oracle=f"""
WITH rep AS (SELECT r, {X} AS x1, {X2} AS x2, {Y} AS y, {_poisson_sql(_UR)} AS w FROM {PANEL_SQL}, range(0, 200) t(r)
             WHERE {X} IS NOT NULL AND {X2} IS NOT NULL AND {Y} IS NOT NULL),
m AS (SELECT r, sum(w * x1) / sum(w) AS m1, sum(w * x2) / sum(w) AS m2, sum(w * y) / sum(w) AS my FROM rep GROUP BY r),
c AS (SELECT r, any_value(m1) AS m1, any_value(m2) AS m2, any_value(my) AS my,
             sum(w * (x1 - m1) * (x1 - m1)) AS s11, sum(w * (x1 - m1) * (x2 - m2)) AS s12, sum(w * (x2 - m2) * (x2 - m2)) AS s22,
             sum(w * (x1 - m1) * (y - my)) AS s1y, sum(w * (x2 - m2) * (y - my)) AS s2y FROM rep JOIN m USING (r) GROUP BY r),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c)
SELECT CAST(r AS INTEGER) AS rep, round(sqrt(avg((y - my - b1 * (x1 - m1) - b2 * (x2 - m2)) * (y - my - b1 * (x1 - m1) - b2 * (x2 - m2)))), 3) + 0.0 AS oob_rmse,
       count(*) AS n_oob
FROM rep JOIN b USING (r) WHERE w = 0 GROUP BY r
""")
def bootstrap_refit(spark, sf):
    """EVA4: weighted Gram per replicate (one grouped pass) + out-of-bag RMSE."""
    rows = E.bootstrap_refit_rmse(_panel(spark, sf), Y, [X, X2], ["c_custkey", "year"], n_boot=200, seed=1)
    return rounded(small_frame(spark, [(int(r["_rep"]), r["oob_rmse"], int(r["n_oob"])) for r in rows],
                               "rep int, oob_rmse double, n_oob long"), 3)


@query("calibration_bins", oracle=f"""
WITH {_chain_sql([X, X2], Y)},
pr AS (SELECT c_custkey, year, {Y} AS y, {_b0(2)} + {_beta(0, 2)} * {X} + {_beta(1, 2)} * {X2} AS p FROM {PANEL_SQL}, fit),
ed AS (SELECT DISTINCT unnest(quantile_cont(p, [{", ".join(f"{i / 10!r}" for i in range(11))}])) AS edge FROM pr),
el AS (SELECT list(edge) AS edges FROM ed),
bn AS (SELECT pr.*, CAST(greatest(len(list_filter(edges, lambda e: e < p)), 1) AS INTEGER) AS bin FROM pr, el),
rep AS (SELECT bin, y, r, {_poisson_sql(_UB.replace("'3:'", "'2:'"))} AS w FROM bn, range(0, 100) t(r)),
per AS (SELECT bin, r, sum(w * y) / sum(w) AS m FROM rep WHERE w > 0 GROUP BY bin, r),
ci AS (SELECT bin, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM per GROUP BY bin)
SELECT bin, count(*) AS n, {_r("avg(p)")} AS mean_pred, {_r("avg(y)")} AS mean_obs,
       {_r("CASE WHEN count(*) > 1 THEN max(low) ELSE avg(y) END")} AS ci_low, {_r("CASE WHEN count(*) > 1 THEN max(high) ELSE avg(y) END")} AS ci_high
FROM bn JOIN ci USING (bin) GROUP BY bin
""")
def calibration_bins(spark, sf):
    """EVA5: quantile bins of predictions with bootstrap CI of the observed bin mean."""
    p = panels.materialize(_panel(spark, sf))
    m = L.fit_ols(p, Y, [X, X2])
    pred = p.select("c_custkey", "year", F.col(Y).alias("y"), m.predict_expr().alias("p"))
    return rounded(E.calibration(pred, "y", "p", q=10, n_boot=100, seed=2, key=["c_custkey", "year"]))


# --- OLS5/FN5: spline terms, OLS6 band, OLS7 interaction grid -----------------------------------------------------------
@query("spline_fit")
def spline_fit(spark, sf):
    p = _panel(spark, sf)
    m = L.fit_ols(p, Y, [X, "bs(avg_value, df=4, degree=3)"])
    return rounded(m.coefficients(spark).select("term", "coef", "std_err"))


_BAND = f"""(SELECT 1.0 + CAST(i AS DOUBLE) AS x FROM range(0, 10) t(i))"""


@query("confidence_band", oracle=f"""
WITH {_TWO},
f AS (SELECT *, n * (w - b1 * u - b2 * v) / (n - 3) AS s2, {_t975_sql("(n - 3)")} AS q FROM k),
g AS (SELECT x, my + b1 * (x - m1) AS fit,
             sqrt(s2 * (1.0 / n + (x - m1) * (x - m1) * d / (n * (a * d - b * b)))) AS se, q FROM {_BAND}, f)
SELECT {_r("x")} AS {X}, {_r("fit")} AS fit, {_r("fit - q * se")} AS lower, {_r("fit + q * se")} AS upper FROM g
""")
def confidence_band(spark, sf):
    p = _panel(spark, sf)
    m = L.fit_ols(p, Y, [X, X2])
    mean_x2 = p.agg(F.avg(X2)).first()[0]
    return rounded(E.confidence_band(m, spark, X, 1.0, 10.0, {X2: mean_x2}, n_points=10))


#: the panel's segments after the first, as the dummies of ``C(c_mktsegment)``
_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_DUMMIES = [f"CAST(c_mktsegment = '{s}' AS INTEGER)" for s in _SEGMENTS]


def _at_sql(values):
    """Fit and its standard error at a row of values, in the model that ``_chain_sql`` fits to as many predictors."""
    k = len(values)
    d = [f"({v} - m_{i})" for i, v in enumerate(values)]
    fit = f"{_b0(k)}" + "".join(f" + {_beta(i, k)} * {v}" for i, v in enumerate(values))
    spread = " + ".join(f"{1 if i == j else 2} * {d[i]} * {d[j]} * (-{_cell(i, j)})" for i in range(k) for j in range(i, k))
    return fit, f"sqrt({_cell(k, k)} / (n - {k + 1}) * (1.0 / n + {spread}))"


_EFFECT, _EFFECT_SE = _at_sql(["g", "mean", *["0"] * len(_SEGMENTS)])
_LEVEL, _LEVEL_SE = _at_sql(["mx", "m2", *[f"CAST(level = '{s}' AS INTEGER)" for s in _SEGMENTS]])
_NU = f"(n - {len(_SEGMENTS) + 3})"


@query("effect_band", oracle=f"""
WITH {_chain_sql([X, X2, *_DUMMIES], Y)},
gr AS (SELECT min({X}) + unnest(range(300)) * ((max({X}) - min({X})) / 299.0) AS g, avg({X2}) AS mean FROM {PANEL_SQL}),
b AS (SELECT g, {_EFFECT} AS fit, {_EFFECT_SE} AS se, {_t975_sql(_NU)} AS q FROM fit, gr)
SELECT round(g, 4) + 0.0 AS {X}, round(fit, 4) + 0.0 AS fit, round(fit - q * se, 4) + 0.0 AS lower, round(fit + q * se, 4) + 0.0 AS upper FROM b
""")
def effect_band(spark, sf):
    """OLS6: band along one predictor, the number at its mean and the category at its first level."""
    p = _panel(spark, sf)
    return rounded(E.effect_band(L.fit_ols(p, Y, [X, X2, "C(c_mktsegment)"]), p, X), 4)


@query("effect_by_level", oracle=f"""
WITH {_chain_sql([X, X2, *_DUMMIES], Y)},
lv AS (SELECT c_mktsegment AS level, (SELECT avg({X}) FROM {PANEL_SQL}) AS mx, (SELECT avg({X2}) FROM {PANEL_SQL}) AS m2 FROM {PANEL_SQL} GROUP BY c_mktsegment),
b AS (SELECT level, {_LEVEL} AS fit, {_LEVEL_SE} AS se, {_t975_sql(_NU)} AS q FROM fit, lv)
SELECT level AS c_mktsegment, round(fit, 4) + 0.0 AS fit, round(fit - q * se, 4) + 0.0 AS lower, round(fit + q * se, 4) + 0.0 AS upper FROM b
""")
def effect_by_level(spark, sf):
    """OLS6: mean response and band of every level of a category, the numbers at their means."""
    p = _panel(spark, sf)
    return rounded(E.effect_band(L.fit_ols(p, Y, [X, X2, "C(c_mktsegment)"]), p, "c_mktsegment"), 4)


@query("interaction_effects", oracle=f"""
WITH {_chain_sql([X, X2, f"({X} * {X2})"], Y)},
lv AS (SELECT DISTINCT unnest([quantile_cont({X}, 0.25), quantile_cont({X}, 0.5), quantile_cont({X}, 0.75)]) AS b FROM {PANEL_SQL}),
gr AS (SELECT min({X2}) + unnest(range(12)) * ((max({X2}) - min({X2})) / 11) AS g FROM {PANEL_SQL})
SELECT CAST(b AS DOUBLE) AS {X}, round(g, 4) + 0.0 AS {X2},
       round({_b0(3)} + {_beta(0, 3)} * b + {_beta(1, 3)} * g + {_beta(2, 3)} * b * g, 4) + 0.0 AS yhat
FROM fit, lv, gr
""")
def interaction_effects(spark, sf):
    """OLS7: predictions over x at the quartiles of ``by``."""
    p = _panel(spark, sf)
    m = L.fit_ols(p, Y, [X, X2, f"{X}:{X2}"])
    return rounded(E.interaction_grid(m, p, X2, X, n_points=12, probs=(0.25, 0.5, 0.75)), 4)


# --- OLS9: panel regression with lagged target and entity fixed effects ------------------------------------------------
_FE = ["lag", "x", "trend"]
_FE_COLUMNS = [*_FE, "y"]


@query("panel_fixed_effects", oracle=f"""
WITH lagged AS (SELECT c_custkey, {Y}::DOUBLE AS y, lag({Y}) OVER (PARTITION BY c_custkey ORDER BY year)::DOUBLE AS lag, {X}::DOUBLE AS x, (year - 1995)::DOUBLE AS trend
                FROM {PANEL_SQL} QUALIFY lag IS NOT NULL),
taken AS (SELECT count(DISTINCT c_custkey) AS entities FROM lagged),
dev AS (SELECT {", ".join(f"{c} - avg({c}) OVER (PARTITION BY c_custkey) AS {c}" for c in _FE_COLUMNS)} FROM lagged),
e0 AS (SELECT {", ".join(f"fsum({_FE_COLUMNS[i]} * {_FE_COLUMNS[j]}) AS {_cell(i, j)}" for i in range(4) for j in range(i, 4))} FROM dev),
f1 AS ({sweep_sql("e0", 3, 0)}), f2 AS ({sweep_sql("f1", 3, 1)}), f3 AS ({sweep_sql("f2", 3, 2)}),
nu AS (SELECT count(*) - 3 - max(entities) AS nu FROM dev, taken),
rows AS ({" UNION ALL ".join(f"SELECT '{t}' AS term, {_beta(i, 3)} AS b, sqrt(-{_cell(i, i)} * {_cell(3, 3)} / nu) AS se, nu FROM f3, nu"
                             for i, t in enumerate([f"{Y}_lag1", X, "trend"]))})
SELECT term, {_r("b")} AS coef, {_r("se")} AS std_err, {_r("b / se")} AS t, {_r(_t_sf2_sql("(b / se)", "nu"))} AS p_value,
       {_r(f"b - {_t975_sql('nu')} * se")} AS ci_low, {_r(f"b + {_t975_sql('nu')} * se")} AS ci_high FROM rows
""")
def panel_fixed_effects(spark, sf):
    p = _panel(spark, sf).select("c_custkey", "year", Y, X)
    lagged = lag_by_entity(p, "c_custkey", "year", Y)
    lagged = lagged.withColumn("trend", F.col("year") - F.lit(1995))
    within = L.within_transform(lagged, "c_custkey", [Y, f"{Y}_lag1", X, "trend"])
    n_entities = lagged.agg(F.countDistinct("c_custkey")).first()[0]
    m = L.fit_ols(within, Y, [f"{Y}_lag1", X, "trend"], intercept=False, absorbed=n_entities)
    return rounded(m.coefficients(spark))


_ABSORBED = f"""s AS (SELECT sum(x * x) AS a, sum(x * z) AS b, sum(z * z) AS d, sum(x * y) AS u, sum(z * y) AS v, sum(y * y) AS w, CAST(count(*) AS DOUBLE) AS n FROM dev),
k AS (SELECT *, a * d - b * b AS det FROM s), f AS (SELECT *, (d * u - b * v) / det AS b1, (a * v - b * u) / det AS b2 FROM k),
e AS (SELECT *, (w - b1 * u - b2 * v) / (n - 2 - taken) AS s2 FROM f, g)
SELECT unnest(['{X}', '{X2}']) AS term, unnest([{_r("b1")}, {_r("b2")}]) AS coef, unnest([{_r("sqrt(s2 * d / det)")}, {_r("sqrt(s2 * a / det)")}]) AS std_err FROM e"""


@query("absorbed_customers", oracle=f"""
WITH dev AS (SELECT {X} - avg({X}) OVER c AS x, {X2} - avg({X2}) OVER c AS z, {Y} - avg({Y}) OVER c AS y FROM {PANEL_SQL} WINDOW c AS (PARTITION BY c_custkey)),
g AS (SELECT count(DISTINCT c_custkey) AS taken FROM {PANEL_SQL}),
{_ABSORBED}""")
def absorbed_customers(spark, sf):
    """FN4, OLS9: a level for every customer."""
    m = AB.fit_absorbed(_panel(spark, sf), Y, [X, X2], "c_custkey")
    return rounded(m.coefficients(spark).select("term", "coef", "std_err"))


@query("absorbed_two_way", oracle=f"""
WITH RECURSIVE it AS (
  SELECT 0 AS step, c_custkey, year, {X}::DOUBLE AS x, {X2}::DOUBLE AS z, {Y}::DOUBLE AS y FROM {PANEL_SQL}
  UNION ALL
  (WITH c AS (SELECT step, c_custkey, year, x - avg(x) OVER w AS x, z - avg(z) OVER w AS z, y - avg(y) OVER w AS y FROM it WHERE step < 60 WINDOW w AS (PARTITION BY c_custkey))
   SELECT step + 1, c_custkey, year, x - avg(x) OVER w, z - avg(z) OVER w, y - avg(y) OVER w FROM c WINDOW w AS (PARTITION BY year))),
dev AS (SELECT * FROM it WHERE step = 60),
g AS (SELECT count(DISTINCT c_custkey) + count(DISTINCT year) - 1 AS taken FROM {PANEL_SQL}),
{_ABSORBED}""")
def absorbed_two_way(spark, sf):
    """FN4, OLS9: a level for every customer and every year."""
    m = AB.fit_absorbed(_panel(spark, sf), Y, [X, X2], ["c_custkey", "year"])
    return rounded(m.coefficients(spark).select("term", "coef", "std_err"))


# --- OUT4 / CHD8 ------------------------------------------------------------------------------------------------------------
@query("residual_outliers", oracle=f"""
WITH {_SIMPLE},
r AS (SELECT p.c_custkey, p.year, (p.{Y} - (b0 + b1 * p.{X})) / sqrt(s2 * (1 - (1.0 / n + (p.{X} - mx) * (p.{X} - mx) / sxx)))
             AS studentized FROM {PANEL_SQL} p, e),
z AS (SELECT avg(studentized) AS m, stddev_samp(studentized) AS sd FROM r)
SELECT c_custkey, year, {_r("studentized")} AS studentized FROM r, z WHERE abs(studentized - m) > 3 * sd
""")
def residual_outliers(spark, sf):
    p = _panel(spark, sf)
    flagged = D.residual_outliers(L.fit_ols(p, Y, [X]), p, keep=["c_custkey", "year"], threshold=3.0)
    return rounded(flagged.filter(F.col("studentized_outlier")).select("c_custkey", "year", "studentized"))


def _qq_sql(m: int) -> str:
    """Sample quantiles of studentized residuals in SQL; theoretical normal quantiles as literals."""
    from ..functions.tails import norm_ppf

    probs = [(i + 0.5) / m for i in range(m)]
    plist = ", ".join(repr(p) for p in probs)
    tlist = ", ".join(repr(norm_ppf(p)) for p in probs)
    return f"""
WITH {_SIMPLE},
r AS (SELECT (p.{Y} - (b0 + b1 * p.{X})) / sqrt(s2 * (1 - (1.0 / n + (p.{X} - mx) * (p.{X} - mx) / sxx)))
             AS studentized FROM {PANEL_SQL} p, e),
q AS (SELECT unnest([{plist}]::DOUBLE[]) AS prob, unnest([{tlist}]::DOUBLE[]) AS theoretical,
             unnest(quantile_cont(studentized, [{plist}])) AS sample FROM r)
SELECT {_r("prob")} AS prob, {_r("theoretical")} AS theoretical, {_r("sample")} AS sample FROM q
"""


@query("qq_points", oracle=_qq_sql(99))
def qq_points(spark, sf):
    p = _panel(spark, sf)
    return rounded(D.qq_points(D.influence(L.fit_ols(p, Y, [X]), p), m=99))


_TRAIN_TWO = f"""c AS (SELECT CAST(count(*) AS DOUBLE) AS n, var_pop({X}) AS a, covar_pop({X}, {X2}) AS b,
                  var_pop({X2}) AS d, covar_pop({X}, {Y}) AS u, covar_pop({X2}, {Y}) AS v, var_pop({Y}) AS w,
                  avg({X}) AS m1, avg({X2}) AS m2, avg({Y}) AS my FROM {PANEL_SQL} WHERE {_U42} >= 0.2),
k AS (SELECT *, (d * u - b * v) / (a * d - b * b) AS b1, (a * v - b * u) / (a * d - b * b) AS b2 FROM c),
f AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, n * (w - ((d * u - b * v) / (a * d - b * b)) * u
             - ((a * v - b * u) / (a * d - b * b)) * v) AS rss, n * w AS tss FROM k)"""


@query("split_metrics", oracle=f"""
WITH {_TRAIN_TWO},
t AS (SELECT p.{Y} AS y, p.{Y} - (f.b0 + f.b1 * p.{X} + f.b2 * p.{X2}) AS e FROM {PANEL_SQL} p, f WHERE {_U42} < 0.2)
SELECT {_r("(SELECT 1 - avg(e * e) / var_pop(y) FROM t)")} AS test_r2,
       {_r("(SELECT sqrt(avg(e * e)) FROM t)")} AS test_rmse, (SELECT CAST(count(*) AS DOUBLE) FROM t) AS test_n,
       {_r("1 - rss / tss")} AS train_r2, {_r("sqrt(rss / n)")} AS train_rmse,
       {_r("1 - (n - 1) / (n - 3) * (rss / tss)")} AS train_adj_r2,
       {_r("6 + n * (ln(2 * pi()) + ln(rss / n) + 1)")} AS train_aic
FROM f
""")
def split_metrics(spark, sf):
    """MET4: train and test metrics of one split."""
    p = _panel(spark, sf)
    train, test = E.split(p, ["c_custkey", "year"], 0.2, 42)
    m = E.split_metrics(L.fit_ols(train, Y, [X, X2]), test)
    keys = sorted(m)
    return rounded(small_frame(spark, [tuple(float(m[k]) for k in keys)], ", ".join(f"{k} double" for k in keys)))

