"""Registered queries: cleaning, filters, windows, joins, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as K
from ..operators import rank as RK
from ..operators import reshape as R
from ..sources.tables import table
from . import panels
from .catalog import query, rounded

PANEL_SQL = panels.CUSTOMER_YEAR_PANEL_SQL
NULL_PANEL_SQL = panels.PLANTED_NULLS_SQL
NATION_SQL = panels.NATION_YEAR_PANEL_SQL
_FILL = ["avg_value", "max_value", "share_finished"]


def _null_panel(spark, sf):
    return panels.with_planted_nulls(panels.customer_year_panel(spark, sf))


# --- CLN1/WIN1: carry forward (ordered scan over range partitions) ------------------------------
@query("carry_forward", oracle=f"""
SELECT c_custkey, year, {", ".join(
    f"round(last_value({c} IGNORE NULLS) OVER (PARTITION BY c_custkey ORDER BY year "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) + 0.0 AS {c}" for c in _FILL)}
FROM {NULL_PANEL_SQL}
""")
def carry_forward(spark, sf):
    df = _null_panel(spark, sf).select("c_custkey", "year", *_FILL)
    return rounded(K.carry_forward(df, "c_custkey", "year", _FILL))


@query("carry_forward_complete", oracle=f"""
SELECT * FROM (SELECT c_custkey, year, {", ".join(
    f"round(last_value({c} IGNORE NULLS) OVER (PARTITION BY c_custkey ORDER BY year "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) + 0.0 AS {c}" for c in _FILL)}
FROM {NULL_PANEL_SQL}) WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _FILL)}
""")
def carry_forward_complete(spark, sf):
    """CLN1 with ``drop_remaining`` (single-window variant)."""
    df = _null_panel(spark, sf).select("c_custkey", "year", *_FILL)
    return rounded(K.carry_forward(df, "c_custkey", "year", _FILL, drop_remaining=True))


# --- CLN2/CLN3/CLN5/CLN6: imputation ---------------------------------------------------------------
def _fill_sql(fn):
    return f"""
SELECT c_custkey, year, {", ".join(
        f"round(coalesce({c}, (SELECT {fn(c)} FROM {NULL_PANEL_SQL})), 6) + 0.0 AS {c}" for c in _FILL)}
FROM {NULL_PANEL_SQL}
"""


@query("impute_median", oracle=_fill_sql(lambda c: f"quantile_cont({c}, 0.5)"))
def impute_median(spark, sf):
    df = _null_panel(spark, sf).select("c_custkey", "year", *_FILL)
    return rounded(K.impute(df, _FILL, "median"))


@query("impute_mean", oracle=_fill_sql(lambda c: f"avg({c})"))
def impute_mean(spark, sf):
    df = _null_panel(spark, sf).select("c_custkey", "year", *_FILL)
    return rounded(K.impute(df, _FILL, "mean"))


@query("impute_zero", oracle=f"""
SELECT c_custkey, year, {", ".join(f"round(coalesce({c}, 0.0), 6) + 0.0 AS {c}" for c in _FILL)}
FROM {NULL_PANEL_SQL}
""")
def impute_zero(spark, sf):
    df = _null_panel(spark, sf).select("c_custkey", "year", *_FILL)
    return rounded(K.impute(df, _FILL, "zero"))


@query("impute_drop", oracle=f"""
SELECT c_custkey, year, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _FILL)}
FROM {NULL_PANEL_SQL} WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _FILL)}
""")
def impute_drop(spark, sf):
    """CLN2 ``drop`` = FLT2 complete cases."""
    df = _null_panel(spark, sf).select("c_custkey", "year", *_FILL)
    return rounded(K.impute(df, _FILL, "drop"))


# --- CLN7: mode fill ---------------------------------------------------------------------------------
_MODE_SRC = f"""(SELECT c_custkey, year,
  CASE WHEN (c_custkey + year) % 13 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM {PANEL_SQL})"""


@query("fill_mode", oracle=f"""
SELECT c_custkey, year, coalesce(c_nationkey, (SELECT c_nationkey FROM {_MODE_SRC} WHERE c_nationkey IS NOT NULL
  GROUP BY c_nationkey ORDER BY count(*) DESC, c_nationkey LIMIT 1)) AS c_nationkey
FROM {_MODE_SRC}
""")
def fill_mode(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    df = p.select("c_custkey", "year", F.when((F.col("c_custkey") + F.col("year")) % 13 == 0, None)
                  .otherwise(F.col("c_nationkey")).alias("c_nationkey"))
    return K.fill_mode(df, "c_nationkey")


# --- CLN9: first row per key under an explicit order ------------------------------------------------
@query("dedup_first_order", oracle="""
SELECT o_custkey, o_orderkey, round(o_totalprice / 1024.0, 6) + 0.0 AS price_k FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def dedup_first_order(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey",
                                          (F.col("o_totalprice") / 1024.0).alias("price_k"))
    return rounded(K.dedup_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate"))


# --- CLN10: distinct rows ------------------------------------------------------------------------------
@query("distinct_segments", oracle="SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_segments(spark, sf):
    return table(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


# --- FLT4/FLT3: latest valid year slice -------------------------------------------------------------
@query("latest_valid_year", oracle=f"""
SELECT c_custkey, year, round(avg_value, 6) + 0.0 AS avg_value FROM {NULL_PANEL_SQL}
WHERE year = (SELECT max(year) FROM {NULL_PANEL_SQL} WHERE avg_value IS NOT NULL)
""")
def latest_valid_year(spark, sf):
    df = _null_panel(spark, sf).select("c_custkey", "year", "avg_value")
    y = K.latest_valid_time(df, "year", "avg_value")
    return rounded(K.slice_time(df, "year", y))


# --- AGG1: aggregate by entity ---------------------------------------------------------------------
@query("entity_aggregate", oracle=f"""
SELECT c_custkey, {", ".join(f"round(avg({c}), 6) + 0.0 AS {c}" for c in ["n_orders", "total_value", *_FILL])},
       arg_min(c_mktsegment, year) AS c_mktsegment
FROM {NULL_PANEL_SQL} GROUP BY c_custkey
""")
def entity_aggregate(spark, sf):
    from ..operators.profile import aggregate_by_entity

    df = _null_panel(spark, sf).select("c_custkey", "year", "n_orders", "total_value", *_FILL, "c_mktsegment")
    out = aggregate_by_entity(df, "c_custkey", "year", numeric=["n_orders", "total_value", *_FILL])
    return rounded(out.withColumn("n_orders", F.col("n_orders").cast("double")))


# --- WIN2: lag of the target per entity (segmented) -------------------------------------------------
@query("lag_target", oracle=f"""
SELECT * FROM (SELECT c_custkey, year, round(total_value, 6) + 0.0 AS total_value,
  round(lag(total_value) OVER (PARTITION BY c_custkey ORDER BY year), 6) + 0.0 AS total_value_lag1
  FROM {PANEL_SQL}) WHERE total_value_lag1 IS NOT NULL
""")
def lag_target(spark, sf):
    df = panels.customer_year_panel(spark, sf).select("c_custkey", "year", "total_value")
    return rounded(K.lag_by_entity(df, "c_custkey", "year", "total_value"))


# --- WIN4: row of the minimum per group -------------------------------------------------------------
@query("argmin_per_group", oracle=f"""
SELECT c_nationkey, arg_min(c_custkey, (avg_value, c_custkey, year)) AS c_custkey,
       arg_min(year, (avg_value, c_custkey, year)) AS year, round(min(avg_value), 6) + 0.0 AS avg_value
FROM {PANEL_SQL} GROUP BY c_nationkey
""")
def argmin_per_group(spark, sf):
    df = panels.customer_year_panel(spark, sf).select("c_nationkey", "avg_value", "c_custkey", "year")
    return rounded(K.argmin_by_group(df, ["c_nationkey"], "avg_value"))


# --- WIN3: average rank of ties -------------------------------------------------------------------------
@query("rank_average_ties", oracle=f"""
SELECT n_nationkey, year, n_orders,
  CAST(rank() OVER (PARTITION BY year ORDER BY n_orders DESC) AS DOUBLE)
  + (count(*) OVER (PARTITION BY year, n_orders) - 1) / 2.0 AS rank_avg
FROM {NATION_SQL}
""")
def rank_average_ties(spark, sf):
    df = panels.nation_year_panel(spark, sf).select("n_nationkey", "year", "n_orders")
    return RK.average_rank(df, "n_orders", partition_by=["year"], descending=True, name="rank_avg")


@query("rank_all_orders", oracle="""
SELECT o_orderkey, CAST(rank() OVER (ORDER BY v DESC) AS DOUBLE) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rank_avg
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 100.0 ELSE floor(o_totalprice / 1024) END AS v FROM orders)
""")
def rank_all_orders(spark, sf):
    """WIN3 over a whole table: many ties, and one value that a third of the rows share."""
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 100.0).otherwise(F.floor(F.col("o_totalprice") / 1024)).cast("double").alias("v"))
    return RK.average_rank_of_all(o, "v", name="rank_avg").select("o_orderkey", "rank_avg")


# --- JOI1: code enrichment through a dimension join ----------------------------------------------------
@query("code_enrichment", oracle="""
SELECT n.n_nationkey, n.n_name, r.r_name AS region_code
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def code_enrichment(spark, sf):
    n = table(spark, sf, "nation")
    dim = n.join(table(spark, sf, "region"), n.n_regionkey == F.col("r_regionkey")).select("n_name", "r_name")
    base = n.select("n_nationkey", "n_name")
    return R.enrich_codes(base, "n_name", dim, "n_name", "r_name", code_col="region_code",
                          overrides={"ATLANTIS": "NOWHERE"})


# --- JOI2: panel x series on (key, year) -------------------------------------------------------------
@query("panel_merge", oracle=f"""
SELECT p.c_custkey, p.year, round(p.avg_value, 6) + 0.0 AS avg_value,
       round(n.avg_value, 6) + 0.0 AS nation_avg_value, round(n.share_finished, 6) + 0.0 AS nation_share_finished
FROM {PANEL_SQL} p LEFT JOIN {NATION_SQL} n ON p.c_nationkey = n.n_nationkey AND p.year = n.year
""")
def panel_merge(spark, sf):
    p = panels.customer_year_panel(spark, sf).select("c_custkey", "year", "avg_value",
                                                      F.col("c_nationkey").alias("n_nationkey"))
    n = panels.nation_year_panel(spark, sf).select("n_nationkey", "year",
                                                   F.col("avg_value").alias("nation_avg_value"),
                                                   F.col("share_finished").alias("nation_share_finished"))
    return rounded(R.merge_on_keys(p, n, ["n_nationkey", "year"], "left").drop("n_nationkey"))


# --- JOI3/JOI6: backfill join and missing counts ------------------------------------------------------
@query("backfill_report", oracle=f"""
WITH j AS (SELECT a.*, b.avg_value AS b_avg, b.max_value AS b_max, b.share_finished AS b_share
           FROM {NULL_PANEL_SQL} a LEFT JOIN (SELECT * FROM {PANEL_SQL} WHERE year >= 1997) b
           ON a.c_custkey = b.c_custkey AND a.year = b.year)
SELECT 'avg_value' AS feature, CAST(sum(CASE WHEN avg_value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_before,
       CAST(sum(CASE WHEN coalesce(avg_value, b_avg) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_after FROM j
UNION ALL
SELECT 'max_value', CAST(sum(CASE WHEN max_value IS NULL THEN 1 ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN coalesce(max_value, b_max) IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM j
UNION ALL
SELECT 'share_finished', CAST(sum(CASE WHEN share_finished IS NULL THEN 1 ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN coalesce(share_finished, b_share) IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM j
""")
def backfill_report(spark, sf):
    """Second 'edition' = the raw panel from 1997 on; left join + coalesce, then missing counts."""
    a = _null_panel(spark, sf).select("c_custkey", "year", *_FILL)
    b = panels.customer_year_panel(spark, sf).filter(F.col("year") >= 1997).select(
        "c_custkey", "year", *[F.col(c).alias(f"b_{c}") for c in _FILL])
    joined = R.merge_on_keys(a, b, ["c_custkey", "year"], "left")
    filled = R.backfill(joined, {c: f"b_{c}" for c in _FILL})
    return R.missing_before_after(joined, filled, _FILL)


# --- JOI8/SET2: entities present in one year but not the next ---------------------------------------------
@query("entities_dropped", oracle=f"""
SELECT DISTINCT c_custkey FROM {PANEL_SQL} WHERE year = 1996
EXCEPT SELECT c_custkey FROM {PANEL_SQL} WHERE year = 1997
""")
def entities_dropped(spark, sf):
    p = panels.customer_year_panel(spark, sf).select("c_custkey", "year")
    return R.entities_only_in(p.filter(F.col("year") == 1996), p.filter(F.col("year") == 1997), "c_custkey")


@query("entities_kept", oracle=f"""
SELECT DISTINCT c_custkey FROM {PANEL_SQL} WHERE year = 1996
INTERSECT SELECT c_custkey FROM {PANEL_SQL} WHERE year = 1997
""")
def entities_kept(spark, sf):
    p = panels.customer_year_panel(spark, sf).select("c_custkey", "year")
    return R.entities_in_both(p.filter(F.col("year") == 1996), p.filter(F.col("year") == 1997), "c_custkey")


# --- RSH3/JOI4 and RSH1: long <-> wide yearly series ----------------------------------------------------
def _series(df):
    """The series names of a long frame, in order: one a year of the data."""
    return [r[0] for r in df.select("s").distinct().orderBy("s").collect()]


@query("series_long_to_wide", oracle=f"""
PIVOT (SELECT n_nationkey, 'val_' || year AS s, round(avg_value, 6) + 0.0 AS v FROM {NATION_SQL}) ON s USING max(v) GROUP BY n_nationkey
""")
def series_long_to_wide(spark, sf):
    n = panels.nation_year_panel(spark, sf).select("n_nationkey", F.concat(F.lit("val_"), F.col("year")).alias("s"),
                                                   "avg_value")
    return rounded(R.long_to_wide(n, ["n_nationkey"], "s", "avg_value", _series(n)))


@query("series_wide_to_long", oracle=f"""
SELECT n_nationkey, 'val' AS series, year, round(avg_value, 6) + 0.0 AS value FROM {NATION_SQL}
""")
def series_wide_to_long(spark, sf):
    n = panels.nation_year_panel(spark, sf).select("n_nationkey", F.concat(F.lit("val_"), F.col("year")).alias("s"),
                                                   "avg_value")
    wide = R.long_to_wide(n, ["n_nationkey"], "s", "avg_value", _series(n))
    long = R.wide_to_long(wide, ["n_nationkey"], positive_only=True)
    return rounded(long.filter(F.col("value").isNotNull()))


# --- PRJ1/PRJ3/PRJ4/PRJ5: dirty headers and text values conformed in one projection -------------
@query("conform_headers", oracle="""
SELECT CAST(o_custkey AS VARCHAR) AS country, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS status,
       round(o_totalprice, 6) + 0.0 AS total_price, TRY_CAST(o_orderpriority AS DOUBLE) AS order_priority
FROM orders
""")
def conform_headers(spark, sf):
    from ..sources.csv import conform, normalize_headers

    o = table(spark, sf, "orders")
    dirty = o.select(F.col("o_custkey").cast("string").alias(" Country "),
                     F.year("o_orderdate").cast("string").alias("Year"),
                     F.when(F.col("o_orderstatus") == "F", " Developed ").otherwise("developing").alias(" Status"),
                     F.col("o_totalprice").cast("string").alias("Total / Price"),
                     F.col("o_orderpriority").alias("Order-Priority"))
    return rounded(conform(normalize_headers(dirty)).drop("year_ts"))


# --- PRJ12/PRJ14/PRJ15/PRJ16: derived index columns -----------------------------------------------
@query("derived_indices", oracle=f"""
SELECT n_nationkey, year,
  round(CASE WHEN avg_value * 1024 > 0 THEN (ln(avg_value * 1024) - ln(100)) / (ln(75000) - ln(100)) END, 6) + 0.0
    AS value_index,
  round(CASE WHEN share_finished <> 0.0 THEN share_finished END, 6) + 0.0 AS share_nonzero,
  year - (SELECT min(year) FROM {NATION_SQL}) AS trend,
  round((SELECT max(avg_value) FROM {NATION_SQL}) - avg_value, 6) + 0.0 AS value_gap
FROM {NATION_SQL}
""")
def derived_indices(spark, sf):
    from ..functions import transforms as T

    n = panels.nation_year_panel(spark, sf)
    out = n.select("n_nationkey", "year", T.domain_index(F.col("avg_value") * 1024).alias("value_index"),
                   T.sentinel_to_null(F.col("share_finished"), 0.0).alias("share_nonzero"),
                   F.col("avg_value").alias("value_gap"))
    out = T.time_trend(out, "year", "trend")
    return rounded(T.invert_smaller_better(out, ["value_gap"]))


# --- JOI5: deduplicated attributes joined to the panel ---------------------------------------------
@query("attribute_join", oracle=f"""
SELECT p.c_custkey, p.year, f.o_orderkey AS first_order, f.o_orderpriority AS first_priority
FROM {PANEL_SQL} p LEFT JOIN (
  SELECT o_custkey, o_orderkey, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
  WHERE rn = 1) f ON p.c_custkey = f.o_custkey
""")
def attribute_join(spark, sf):
    p = panels.customer_year_panel(spark, sf).select("c_custkey", "year")
    attrs = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate",
                                              F.col("o_orderkey").alias("first_order"),
                                              F.col("o_orderpriority").alias("first_priority"))
    return R.attach_attributes(p, attrs, "c_custkey", ["o_orderdate", "first_order"]).drop("o_orderdate")


# --- CLN8: drop all-missing columns ----------------------------------------------------------------
@query("drop_empty_columns", oracle=f"""
SELECT c_custkey, year, total_value FROM (SELECT c_custkey, year, round(total_value, 6) + 0.0 AS total_value,
  CAST(NULL AS DOUBLE) AS empty_col FROM {PANEL_SQL})
""")
def drop_empty_columns(spark, sf):
    p = panels.customer_year_panel(spark, sf).select("c_custkey", "year", "total_value",
                                                      F.lit(None).cast("double").alias("empty_col"))
    return rounded(K.drop_all_missing_columns(p))


# --- FN4: one-hot with the first level dropped -----------------------------------------------------
@query("one_hot_segments", oracle="""
SELECT c_custkey, """ + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s.lower()}"
    for s in ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM customer")
def one_hot_segments(spark, sf):
    from ..functions.transforms import one_hot

    c = table(spark, sf, "customer")
    levels = [r[0] for r in c.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]  # categories
    cols = one_hot(F.col("c_mktsegment"), "c_mktsegment", levels, drop_first=True)
    return c.select("c_custkey", *[v.alias(k) for k, v in cols.items()])


# --- FN3: ordered status categories -> dummies (first level dropped) -----------------------------------
@query("status_dummies", oracle=f"""
SELECT c_custkey, year, CASE WHEN share_finished > 0.5 THEN 1 ELSE 0 END AS status_developed FROM {PANEL_SQL}
""")
def status_dummies(spark, sf):
    from ..functions.transforms import status_dummies as dummies

    p = panels.customer_year_panel(spark, sf)
    text = F.when(F.col("share_finished") > 0.5, " Developed ").otherwise("Developing")
    return p.select("c_custkey", "year", *[v.alias(k) for k, v in dummies(text, "status").items()])
