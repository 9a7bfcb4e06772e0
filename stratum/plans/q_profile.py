"""Registered queries: profiling aggregates, outliers, chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.transforms import age_years
from ..operators import outliers as O
from ..operators import profile as PR
from ..sources.tables import table
from . import panels
from .catalog import query, rounded

LI = panels.LINEITEM_FEATURES
LI_SQL = panels.LINEITEM_SQL
PANEL_SQL = panels.CUSTOMER_YEAR_PANEL_SQL
NULL_PANEL_SQL = panels.PLANTED_NULLS_SQL
NATION_SQL = panels.NATION_YEAR_PANEL_SQL
_FILL = ["avg_value", "max_value", "share_finished"]


def _r(x):
    return f"round({x}, 6) + 0.0"


# --- AGG6 ---------------------------------------------------------------------------------------------
@query("describe_features", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, {_r(f'avg({c})')} AS mean, {_r(f'stddev_samp({c})')} AS std, "
    f"{_r(f'min({c})')} AS min, {_r(f'quantile_cont({c}, 0.25)')} AS q25, {_r(f'quantile_cont({c}, 0.5)')} AS q50, "
    f"{_r(f'quantile_cont({c}, 0.75)')} AS q75, {_r(f'max({c})')} AS max FROM {LI_SQL}" for c in LI))
def describe_features(spark, sf):
    return rounded(PR.describe(panels.lineitem(spark, sf), LI))


@query("describe_features_sorted", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, {_r(f'avg({c})')} AS mean, {_r(f'stddev_samp({c})')} AS std, "
    f"{_r(f'min({c})')} AS min, {_r(f'quantile_cont({c}, 0.25)')} AS q25, {_r(f'quantile_cont({c}, 0.5)')} AS q50, "
    f"{_r(f'quantile_cont({c}, 0.75)')} AS q75, {_r(f'max({c})')} AS max FROM {LI_SQL}" for c in LI))
def describe_features_sorted(spark, sf):
    """AGG6 through the distributed-sort exact quantiles (the path taken for high-cardinality columns)."""
    return rounded(PR.describe(panels.lineitem(spark, sf), LI))


# --- AGG7/AGG8 ------------------------------------------------------------------------------------------
@query("missingness_by_year", oracle=" UNION ALL ".join(
    f"SELECT year, '{c}' AS feature, count(*) AS n_rows, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS n_missing, {_r(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*)')} AS pct_missing "
    f"FROM {NULL_PANEL_SQL} GROUP BY year" for c in _FILL))
def missingness_by_year(spark, sf):
    df = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    return rounded(PR.missingness(df, _FILL, by=["year"]))


@query("avg_missingness_by_year", oracle=f"""
SELECT year, {_r("(" + " + ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in _FILL)
                 + f") / {len(_FILL)} * 100.0")} AS avg_missing_pct
FROM {NULL_PANEL_SQL} GROUP BY year
""")
def avg_missingness_by_year(spark, sf):
    df = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    return rounded(PR.average_missingness(df, _FILL, by=["year"]))


# --- AGG3/AGG4 ---------------------------------------------------------------------------------------------
@query("group_summary", oracle=f"""
SELECT l_returnflag, count(l_quantity) AS n, {_r("avg(l_quantity)")} AS mean, {_r("stddev_samp(l_quantity)")} AS sd,
       {_r("stddev_samp(l_quantity) / sqrt(count(l_quantity))")} AS se,
       {_r("avg(l_quantity) - 1.96 * stddev_samp(l_quantity) / sqrt(count(l_quantity))")} AS ci_low,
       {_r("avg(l_quantity) + 1.96 * stddev_samp(l_quantity) / sqrt(count(l_quantity))")} AS ci_high
FROM lineitem GROUP BY l_returnflag
""")
def group_summary(spark, sf):
    return rounded(PR.group_summary(panels.lineitem(spark, sf), ["l_returnflag"], "l_quantity"))


@query("group_stats", oracle=f"""
SELECT c_mktsegment, count(avg_value) AS n, {_r("avg(avg_value)")} AS mean, {_r("stddev_samp(avg_value)")} AS sd,
       {_r("quantile_cont(avg_value, 0.5)")} AS median, {_r("max(avg_value)")} AS max
FROM {PANEL_SQL} GROUP BY c_mktsegment
""")
def group_stats(spark, sf):
    return rounded(PR.group_stats(panels.customer_year_panel(spark, sf), "c_mktsegment", "avg_value"))


# --- AGG5 -------------------------------------------------------------------------------------------------------
@query("yearly_trend", oracle=f"""
SELECT {_r("regr_slope(m, CAST(year AS DOUBLE))")} AS slope, {_r("regr_intercept(m, CAST(year AS DOUBLE))")} AS intercept,
       {_r("arg_max(m, year) - arg_min(m, year)")} AS delta, count(*) AS n_periods
FROM (SELECT year, avg(avg_value) AS m FROM {NATION_SQL} GROUP BY year)
""")
def yearly_trend(spark, sf):
    return rounded(PR.yearly_trend(panels.nation_year_panel(spark, sf), "year", "avg_value"))


# --- AGG10/SET1 -------------------------------------------------------------------------------------------------
def _range_sql(flag):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_r(f'min({c})')} AS min, {_r(f'quantile_cont({c}, 0.5)')} AS median, "
        f"{_r(f'quantile_cont({c}, 0.99)')} AS p99, {_r(f'max({c})')} AS max, '{flag}' AS edition "
        f"FROM {LI_SQL} WHERE l_returnflag = '{flag}'" for c in LI)


@query("range_compare", oracle=" UNION ALL ".join(map(_range_sql, "ANR")))
def range_compare(spark, sf):
    li = panels.lineitem(spark, sf)
    parts = [PR.range_summary(li.filter(F.col("l_returnflag") == flag), LI, flag) for flag in "ANR"]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# --- AGG11 ---------------------------------------------------------------------------------------------------------
@query("tail_shares", oracle=f"""
SELECT {_r("avg(CASE WHEN l_quantity > 45 THEN 1.0 ELSE 0.0 END)")} AS share_above,
       {_r("avg(CASE WHEN l_quantity < 3 THEN 1.0 ELSE 0.0 END)")} AS share_below,
       {_r("quantile_cont(l_quantity, 0.01)")} AS p01, {_r("quantile_cont(l_quantity, 0.99)")} AS p99,
       {_r("max(l_quantity)")} AS max
FROM lineitem
""")
def tail_shares(spark, sf):
    return rounded(PR.tail_shares(panels.lineitem(spark, sf), "l_quantity", upper=45, lower=3))


# --- AGG12/AGG13 ----------------------------------------------------------------------------------------------------
@query("distinct_counts", oracle=f"""
SELECT count(DISTINCT c_custkey) AS n_c_custkey, count(DISTINCT c_nationkey) AS n_c_nationkey,
       count(DISTINCT year) AS n_year, min(year) AS time_min, max(year) AS time_max
FROM {PANEL_SQL}
""")
def distinct_counts(spark, sf):
    return PR.distinct_counts(panels.customer_year_panel(spark, sf), ["c_custkey", "c_nationkey", "year"], time="year")


# --- AGG15 -------------------------------------------------------------------------------------------------------------
_AGREE_SQL = """(SELECT o.o_orderkey, o.o_totalprice / 1024.0 AS a, l.rev / 1024.0 AS b FROM orders o
 JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS rev FROM lineitem GROUP BY 1) l
 ON o.o_orderkey = l.l_orderkey)"""


@query("agreement_metrics", oracle=f"""
SELECT count(*) AS n, {_r("corr(a, b)")} AS pearson, {_r("regr_slope(b, a)")} AS slope,
       {_r("regr_intercept(b, a)")} AS intercept, {_r("avg(b - a)")} AS bias, {_r("avg(abs(b - a))")} AS mae,
       {_r("quantile_cont(abs(b - a), 0.5)")} AS median_abs_err, {_r("quantile_cont(abs(b - a), 0.95)")} AS p95_abs_err,
       {_r("max(abs(b - a))")} AS max_abs_err
FROM {_AGREE_SQL}
""")
def agreement_metrics(spark, sf):
    li = table(spark, sf, "lineitem")
    rev = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("rev"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    j = o.join(rev, o.o_orderkey == rev.l_orderkey).select((F.col("o_totalprice") / 1024.0).alias("a"),
                                                           (F.col("rev") / 1024.0).alias("b"))
    return rounded(PR.agreement(j, "a", "b"))


# --- AGG16 ---------------------------------------------------------------------------------------------------------------
@query("value_sets", oracle="""
SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments,
       round(avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS share
FROM customer GROUP BY c_nationkey
""")
def value_sets(spark, sf):
    c = table(spark, sf, "customer").withColumn("positive", F.col("c_acctbal") > 0)
    out = PR.value_sets(c, ["c_nationkey"], "c_mktsegment", "positive")
    return rounded(out.select("c_nationkey", F.array_join("values", ",").alias("segments"), "share"))


# --- AGG17 -----------------------------------------------------------------------------------------------------------------
@query("modal_entity_set", oracle=f"""
WITH per AS (SELECT year, count(*) AS set_size,
               sum(CAST(('0x' || substr(md5(CAST(c_nationkey AS VARCHAR)), 1, 15)) AS HUGEINT)) AS fp
             FROM (SELECT DISTINCT year, c_nationkey FROM {PANEL_SQL}) GROUP BY year)
SELECT set_size, count(*) AS n_periods, min(year) AS first_period FROM per GROUP BY set_size, fp
ORDER BY n_periods DESC, first_period LIMIT 1
""")
def modal_entity_set(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    return PR.modal_entity_set(p, "year", "c_nationkey")


# --- AGG18/AGG19/AGG20 -------------------------------------------------------------------------------------------------------
@query("equal_width_bins", oracle=f"""
WITH r AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT CAST(least(greatest(ceil((l_quantity - lo) / ((hi - lo) / 10.0)), 1), 10) AS INTEGER) AS bin,
       count(*) AS n, {_r("avg(l_quantity)")} AS mean_x, {_r("avg(l_extendedprice / 1024.0)")} AS mean_value
FROM lineitem, r GROUP BY 1
""")
def equal_width_bins(spark, sf):
    return rounded(PR.equal_width_bins(panels.lineitem(spark, sf), "l_quantity", 10, "price_k"))


@query("quantile_bins", oracle=f"""
WITH e AS (SELECT list_distinct(list_sort(quantile_cont(avg_value, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges
           FROM {PANEL_SQL})
SELECT CAST(greatest(len(list_filter(edges, lambda x: x < avg_value)), 1) AS INTEGER) AS bin, count(*) AS n,
       {_r("avg(avg_value)")} AS mean_x, {_r("avg(total_value)")} AS mean_value
FROM {PANEL_SQL}, e GROUP BY 1
""")
def quantile_bins(spark, sf):
    return rounded(PR.quantile_bins(panels.customer_year_panel(spark, sf), "avg_value", 5, "total_value"))


@query("order_age_years", oracle="""
SELECT CAST(floor(datediff('day', o_orderdate, TIMESTAMP '2002-01-01') / 365) AS INTEGER) AS age, count(*) AS n
FROM orders GROUP BY 1
""")
def order_age_years(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(age_years(F.lit("2002-01-01").cast("date"), F.to_date("o_orderdate")).alias("age")).agg(
        F.count(F.lit(1)).alias("n"))


# --- CHD1/CHD2 ------------------------------------------------------------------------------------------------------------------
@query("histogram_counts", oracle=" UNION ALL ".join(f"""
SELECT '{c}' AS feature, CAST(least(floor(({c} - lo) / ((hi - lo) / 30.0)), 29) AS INTEGER) AS bin,
       {_r("lo + least(floor((" + c + " - lo) / ((hi - lo) / 30.0)), 29) * ((hi - lo) / 30.0)")} AS "left", count(*) AS count
FROM {LI_SQL}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {LI_SQL}) GROUP BY 1, 2, 3""" for c in LI))
def histogram_counts(spark, sf):
    return rounded(PR.histogram(panels.lineitem(spark, sf), LI, bins=30))


@query("box_stats", oracle=" UNION ALL ".join(f"""
SELECT '{c}' AS feature, {_r("q1")} AS q1, {_r("med")} AS median, {_r("q3")} AS q3,
  {_r(f"min(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END)")} AS whisker_low,
  {_r(f"max(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END)")} AS whisker_high,
  CAST(sum(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS BIGINT) AS n_fliers
FROM {PANEL_SQL}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
                          quantile_cont({c}, 0.75) AS q3 FROM {PANEL_SQL})
GROUP BY q1, med, q3""" for c in ["avg_value", "max_value", "total_value"]))
def box_stats(spark, sf):
    return rounded(PR.box_stats(panels.customer_year_panel(spark, sf), ["avg_value", "max_value", "total_value"]))


# --- OUT1/OUT2/OUT5 -------------------------------------------------------------------------------------------------------------
_OUT_COLS = ["total_value", "max_value", "n_orders"]


def _iqr_cte(src):
    return ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in _OUT_COLS) \
        + f" FROM {src}"


def _iqr_flag(c):
    return (f"coalesce({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}), false)")


@query("iqr_outlier_counts", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(sum(CASE WHEN {_iqr_flag(c)} THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers "
    f"FROM {PANEL_SQL}, (SELECT {_iqr_cte(PANEL_SQL)})" for c in _OUT_COLS))
def iqr_outlier_counts(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    return O.iqr_fences(p, _OUT_COLS).counts(p)


@query("iqr_outlier_rows", oracle=f"""
SELECT c_custkey, year, {", ".join(f"{_iqr_flag(c)} AS {c}_outlier" for c in _OUT_COLS)},
       {" + ".join(f"CAST({_iqr_flag(c)} AS INTEGER)" for c in _OUT_COLS)} AS n_flags
FROM {PANEL_SQL}, (SELECT {_iqr_cte(PANEL_SQL)})
""")
def iqr_outlier_rows(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    return O.iqr_fences(p, _OUT_COLS).flag(p, keep=["c_custkey", "year"])


def _z_flag(c):
    return f"coalesce(abs({c} - m_{c}) > 3 * s_{c}, false)"


_Z_CTE = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LI) + f" FROM {LI_SQL}"


@query("zscore_outlier_counts", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(sum(CASE WHEN {_z_flag(c)} THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers "
    f"FROM {LI_SQL}, (SELECT {_Z_CTE})" for c in LI))
def zscore_outlier_counts(spark, sf):
    li = panels.lineitem(spark, sf)
    return O.zscore_fences(li, LI, 3.0).counts(li)


@query("detector_comparison", oracle=f"""
WITH f AS (SELECT {" + ".join(f"CAST({_iqr_flag(c)} AS INTEGER)" for c in _OUT_COLS)} AS n_iqr,
                  {" + ".join(f"CAST(coalesce(abs({c} - m_{c}) > 3 * s_{c}, false) AS INTEGER)" for c in _OUT_COLS)} AS n_z
           FROM {PANEL_SQL}, (SELECT {_iqr_cte(PANEL_SQL)}),
                (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _OUT_COLS)} FROM {PANEL_SQL}))
SELECT count(*) AS n_rows, CAST(sum(CASE WHEN n_iqr > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged,
       {_r("quantile_cont(n_iqr, 0.5)")} AS median_flags,
       {_r("sum(CASE WHEN n_iqr > 0 THEN 1 ELSE 0 END) / count(*)")} AS share_flagged, 'iqr' AS detector FROM f
UNION ALL
SELECT count(*), CAST(sum(CASE WHEN n_z > 0 THEN 1 ELSE 0 END) AS BIGINT), {_r("quantile_cont(n_z, 0.5)")},
       {_r("sum(CASE WHEN n_z > 0 THEN 1 ELSE 0 END) / count(*)")}, 'zscore' FROM f
""")
def detector_comparison(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    flagged = {"iqr": O.iqr_fences(p, _OUT_COLS).flag(p), "zscore": O.zscore_fences(p, _OUT_COLS).flag(p)}
    return rounded(O.compare_detectors(flagged))


@query("unmapped_entities", oracle="""
SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') o ON o_custkey = c_custkey WHERE o_custkey IS NULL
""")
def unmapped_entities(spark, sf):
    """AGG14: customers that no urgent order maps to."""
    seen = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    joined = table(spark, sf, "customer").select("c_custkey").join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
    return PR.unmapped(joined, "c_custkey", "o_custkey")


# --- OUT6/WIN7/TOP3: representative period --------------------------------------------------------------------------------
_PERIOD_SQL = f"""
WITH m AS (SELECT year, ({" + ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in _FILL)}) / 3 * 100.0
                  AS avg_missing_pct FROM {NULL_PANEL_SQL} GROUP BY year),
q AS (SELECT year, {", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                              for c in _OUT_COLS)} FROM {NULL_PANEL_SQL} GROUP BY year),
o AS (SELECT p.year, avg(CASE WHEN {" OR ".join(_iqr_flag(f"p.{c}").replace(f"q1_p.{c}", f"q1_{c}")
                                               .replace(f"q3_p.{c}", f"q3_{c}") for c in _OUT_COLS)}
                         THEN 1.0 ELSE 0.0 END) AS outlier_share, count(*) AS n_rows
      FROM {NULL_PANEL_SQL} p JOIN q ON p.year = q.year GROUP BY p.year)
SELECT m.year, {_r("m.avg_missing_pct")} AS avg_missing_pct, {_r("o.outlier_share")} AS outlier_share, o.n_rows,
       {_r("0.8 * (100.0 - m.avg_missing_pct) + 0.2 * (100.0 - 100.0 * o.outlier_share)")} AS score
FROM m JOIN o ON m.year = o.year
"""


@query("period_scores", oracle=_PERIOD_SQL)
def period_scores(spark, sf):
    df = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    miss = PR.average_missingness(df, _FILL, by=["year"])
    outl = O.anomaly_share_by_period(df, "year", _OUT_COLS)
    return rounded(O.period_score(miss, outl, "year"))


@query("best_period", oracle=f"SELECT year FROM ({_PERIOD_SQL}) ORDER BY score DESC, year DESC LIMIT 1")
def best_period(spark, sf):
    """TOP3: the period of the best score of missing values and outliers, ties -> latest."""
    df = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    miss = PR.average_missingness(df, _FILL, by=["year"])
    outl = O.anomaly_share_by_period(df, "year", _OUT_COLS)
    return O.period_score(miss, outl, "year").select("year").limit(1)


@query("minmax_scores", oracle=f"""
SELECT n_nationkey, year, {_r("(avg_value - min(avg_value) OVER ()) * 100.0 / (max(avg_value) OVER () - min(avg_value) OVER ())")}
       AS avg_value_scaled FROM {NATION_SQL}
""")
def minmax_scores(spark, sf):
    n = panels.nation_year_panel(spark, sf).select("n_nationkey", "year", "avg_value")
    return rounded(O.minmax_scaled(n, "avg_value").drop("avg_value"))


# --- AGG9: missingness of two editions ------------------------------------------------------------------
@query("edition_missing_compare", oracle=f"""
WITH a AS (SELECT * FROM {PANEL_SQL}), b AS (SELECT * FROM {NULL_PANEL_SQL})
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {_r(f"(SELECT avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0.0 END) FROM a)")} AS pct_missing_raw,
    {_r(f"(SELECT avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0.0 END) FROM b)")} AS pct_missing_planted,
    {_r(f"(SELECT avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0.0 END) FROM b) - (SELECT avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0.0 END) FROM a)")} AS delta"""
    for c in ["n_orders", "total_value", "avg_value", "max_value", "share_finished", "c_nationkey", "acctbal"]))
def edition_missing_compare(spark, sf):
    a = panels.customer_year_panel(spark, sf).drop("c_custkey", "year")
    b = panels.with_planted_nulls(panels.customer_year_panel(spark, sf)).drop("c_custkey", "year")
    return rounded(PR.missing_compare(a, b, "raw", "planted"))


# --- AGG14: coverage table ------------------------------------------------------------------------------
_COV_SQL = f"""(SELECT p.c_custkey, p.share_finished, CASE WHEN p.c_nationkey < 20 THEN n.n_name END AS code
  FROM {PANEL_SQL} p JOIN nation n ON p.c_nationkey = n.n_nationkey)"""


@query("coverage_table", oracle=f"""
SELECT count(*) AS n_rows, count(DISTINCT c_custkey) AS n_entities,
       {_r("avg(CASE WHEN code IS NOT NULL THEN 1.0 ELSE 0.0 END)")} AS mapped_share,
       CAST(sum(CASE WHEN share_finished = 0.0 THEN 1 ELSE 0 END) AS BIGINT) AS n_sentinel
FROM {_COV_SQL}
""")
def coverage_table(spark, sf):
    """Codes exist only for nations 0-19 of the dimension: the rest count as unmapped."""
    p = panels.customer_year_panel(spark, sf)
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = p.join(F.broadcast(n), p.c_nationkey == n.n_nationkey).select(  # nation: 25 rows at every scale
        "c_custkey", "share_finished", F.when(F.col("c_nationkey") < 20, F.col("n_name")).alias("code"))
    return rounded(PR.coverage(j, "c_custkey", "code", "share_finished", 0.0))


# --- CHD5: feature-vs-target long table -------------------------------------------------------------------
@query("feature_target_long", oracle=" UNION ALL ".join(
    f"SELECT c_custkey, year, '{c}' AS feature, {_r(c)} AS value, {_r('total_value')} AS target, c_mktsegment "
    f"FROM {PANEL_SQL}" for c in ["n_orders", "avg_value", "share_finished"]))
def feature_target_long(spark, sf):
    from ..operators.reshape import melt

    p = panels.customer_year_panel(spark, sf).select(
        "c_custkey", "year", F.col("total_value").alias("target"), "c_mktsegment",
        F.col("n_orders").cast("double").alias("n_orders"), "avg_value", "share_finished")
    return rounded(melt(p, ["c_custkey", "year", "target", "c_mktsegment"], ["n_orders", "avg_value",
                                                                             "share_finished"]))
