"""Panels derived from the driver tables.

Every registered query starts from one of these, so its work grows with the
tables.  Each builder has a SQL twin (``*_SQL``) used by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

LINEITEM_FEATURES = ["l_quantity", "price_k", "l_discount", "l_tax"]
# Money columns are divided by 1024 (not 1000): the quotient stays exact in
# binary floating point, so means of two-decimal prices never sit exactly on a
# decimal rounding boundary when results are compared across engines.
PANEL_FEATURES = ["n_orders", "total_value", "avg_value", "max_value", "share_finished", "acctbal"]


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-section: one row per line item, keys + numeric features."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     (F.col("l_extendedprice") / 1024.0).alias("price_k"), "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus", "l_shipdate")


LINEITEM_SQL = """
(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice / 1024.0 AS price_k, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate FROM lineitem)
"""


def customer_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gappy entity x year panel (money in units of 1024, exact in binary): orders pre-aggregated per (customer, year), then
    joined to the customer dimension (aggregate before the join: the shuffle
    carries one row per customer-year, not one per order)."""
    o = table(spark, sf_dir, "orders")
    per_year = o.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        (F.sum("o_totalprice") / 1024.0).alias("total_value"),
        (F.avg("o_totalprice") / 1024.0).alias("avg_value"),
        (F.max("o_totalprice") / 1024.0).alias("max_value"),
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("share_finished"),
    )
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", (F.col("c_acctbal") / 1024.0).alias("acctbal"), "c_mktsegment")
    return per_year.join(c, "c_custkey")


CUSTOMER_YEAR_PANEL_SQL = """
(SELECT p.c_custkey, p.year, p.n_orders, p.total_value, p.avg_value, p.max_value, p.share_finished,
        c.c_nationkey, c.c_acctbal / 1024.0 AS acctbal, c.c_mktsegment
 FROM (SELECT o_custkey AS c_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
              count(*) AS n_orders, sum(o_totalprice) / 1024.0 AS total_value,
              avg(o_totalprice) / 1024.0 AS avg_value, max(o_totalprice) / 1024.0 AS max_value,
              avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS share_finished
       FROM orders GROUP BY 1, 2) p
 JOIN customer c ON p.c_custkey = c.c_custkey)
"""


def with_planted_nulls(panel: DataFrame) -> DataFrame:
    """The tables hold no NULLs; plant some by fixed rules to exercise cleaning."""
    key = F.col("c_custkey") + F.col("year")
    return panel.withColumns({
        "avg_value": F.when(key % 5 == 0, None).otherwise(F.col("avg_value")),
        "max_value": F.when(key % 7 == 3, None).otherwise(F.col("max_value")),
        "share_finished": F.when(key % 11 == 4, None).otherwise(F.col("share_finished")),
    })


PLANTED_NULLS_SQL = f"""
(SELECT c_custkey, year, n_orders, total_value,
        CASE WHEN (c_custkey + year) % 5 = 0 THEN NULL ELSE avg_value END AS avg_value,
        CASE WHEN (c_custkey + year) % 7 = 3 THEN NULL ELSE max_value END AS max_value,
        CASE WHEN (c_custkey + year) % 11 = 4 THEN NULL ELSE share_finished END AS share_finished,
        c_nationkey, acctbal, c_mktsegment
 FROM {CUSTOMER_YEAR_PANEL_SQL})
"""


def nation_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense panel (nation x year): order value statistics per nation and year.

    Orders are reduced to (customer, year) sums and counts before the join,
    so the join moves one row per customer-year instead of one per order;
    the nation dimension (25 rows at every scale) is broadcast.
    """
    o = table(spark, sf_dir, "orders")
    per_cust = o.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("o_totalprice").alias("_s"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("_f"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    per = (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
           .groupBy(F.col("c_nationkey").alias("n_nationkey"), "year")
           .agg(F.sum("_n").alias("n_orders"), (F.sum("_s") / 1048576.0).alias("total_value"),
                (F.sum("_s") / F.sum("_n") / 1024.0).alias("avg_value"),
                (F.sum("_f") / F.sum("_n")).alias("share_finished")))
    return per.join(F.broadcast(n), "n_nationkey")


NATION_YEAR_PANEL_SQL = """
(SELECT p.n_nationkey, p.year, p.n_orders, p.total_value, p.avg_value, p.share_finished, n.n_name, n.n_regionkey
 FROM (SELECT c_nationkey AS n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders,
              sum(o_totalprice) / 1048576.0 AS total_value, avg(o_totalprice) / 1024.0 AS avg_value,
              avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS share_finished
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) p
 JOIN nation n ON p.n_nationkey = n.n_nationkey)
"""


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a derived panel that several passes will read.

    ``checkpoint`` writes it once to the shared folder named by
    ``spark.checkpoint.dir`` (never a machine-local folder on a cluster); later
    passes read those files instead of re-aggregating the source tables, and a
    lost executor does not force the aggregation to run again.
    """
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
