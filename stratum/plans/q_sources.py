"""Registered queries: sinks and CSV sources, exercised as write -> read round trips.

Each query writes data derived from the driver tables into a fresh folder
under the shared checkpoint directory (``spark.checkpoint.dir``), reads it
back through the loader under test and returns the conformed rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.reshape import wide_to_long
from ..session import scratch_path
from ..sources import csv as SC
from . import panels
from .catalog import query, rounded

PANEL_SQL = panels.CUSTOMER_YEAR_PANEL_SQL
NATION_SQL = panels.NATION_YEAR_PANEL_SQL


@query("panel_parquet_roundtrip", oracle=f"""
SELECT c_custkey, year, round(total_value, 6) + 0.0 AS total_value FROM {PANEL_SQL} WHERE year = 1997
""")
def panel_parquet_roundtrip(spark, sf):
    """SNK1 + FLT3: year-partitioned parquet; the year filter prunes partitions at the scan."""
    path = scratch_path(spark, "panel-parquet")
    panel = panels.customer_year_panel(spark, sf).select("c_custkey", "year", "total_value")
    SC.write_panel(panel, path, partition_by=("year",))
    back = spark.read.parquet(path).filter(F.col("year") == 1997)
    return rounded(back.select("c_custkey", F.col("year").cast("int").alias("year"), "total_value"))


@query("panel_csv_roundtrip", oracle=f"""
SELECT CAST(c_custkey AS VARCHAR) AS country, year, CASE WHEN share_finished > 0.5 THEN 1 ELSE 0 END AS status,
       round(total_value, 6) + 0.0 AS total_value, round(avg_value, 6) + 0.0 AS avg_value,
       round(max_value, 6) + 0.0 AS max_value
FROM {PANEL_SQL}
""")
def panel_csv_roundtrip(spark, sf):
    """SRC1 + PRJ1-PRJ5: dirty headers and text values written as CSV, loaded by ``read_panel``."""
    path = scratch_path(spark, "panel-csv")
    p = panels.customer_year_panel(spark, sf)
    dirty = p.select(F.col("c_custkey").cast("string").alias("Country"), F.col("year").cast("string").alias("Year"),
                     F.when(F.col("share_finished") > 0.5, " Developed").otherwise("Developing").alias(" Status "),
                     F.col("total_value").alias("Total  Value "), F.col("avg_value").alias("Avg-Value"),
                     F.col("max_value").alias("Max / Value"))
    dirty.write.mode("overwrite").option("header", True).csv(path)
    back = SC.read_panel(spark, path, target="total_value")
    return rounded(back.drop("year_ts"))


@query("semicolon_csv_roundtrip", oracle=f"""
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, CAST(year AS VARCHAR) AS year,
       round(avg_value, 2) + 0.0 AS avg_value, round(share_finished, 4) + 0.0 AS share_finished
FROM {NATION_SQL}
""")
def semicolon_csv_roundtrip(spark, sf):
    """SRC4: ``;`` separated CSV with comma decimals, parsed with ``try_cast(replace(',', '.'))``."""
    path = scratch_path(spark, "nation-semicolon")
    n = panels.nation_year_panel(spark, sf)
    out = n.select("n_nationkey", "year",
                   F.regexp_replace(F.format_string("%.2f", "avg_value"), r"\.", ",").alias("avg_value"),
                   F.regexp_replace(F.format_string("%.4f", "share_finished"), r"\.", ",").alias("share_finished"))
    out.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    back = SC.read_semicolon_comma_decimal(spark, path, ["avg_value", "share_finished"])
    return rounded(back)


@query("wide_csv_roundtrip", oracle=f"""
SELECT CAST(n_nationkey AS VARCHAR) AS iso3, 'val' AS series, year, round(avg_value, 6) + 0.0 AS value
FROM {NATION_SQL}
""")
def wide_csv_roundtrip(spark, sf):
    """SRC3 + RSH1 (rule R21): Latin-1 wide CSV of all years with a shadowing prefix; only wanted columns are read."""
    path = scratch_path(spark, "wide-series")
    n = panels.nation_year_panel(spark, sf)
    years = [r[0] for r in n.select("year").distinct().orderBy("year").collect()]
    wide = n.groupBy(F.col("n_nationkey").cast("string").alias("iso3")).pivot("year", years).agg(
        F.first("avg_value"))
    wide = wide.select("iso3", *[F.col(str(y)).alias(f"val_{y}") for y in years],
                       *[(F.col(str(y)) * 2).alias(f"val_f_{y}") for y in years])
    wide.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    back = SC.read_wide_series(spark, path, ["val"], id_columns=("iso3",))
    return rounded(wide_to_long(back, ["iso3"]))


@query("edition2_roundtrip", oracle=f"""
SELECT n.n_name AS country, n.year, CASE WHEN n.share_finished > 0.5 THEN 1 ELSE 0 END AS status,
       round(CAST(n.n_orders AS DOUBLE) * 1000.0, 6) + 0.0 AS population, round(n.avg_value, 6) + 0.0 AS alcohol,
       CAST(n.n_regionkey AS VARCHAR) AS region, round(e.total_value, 6) + 0.0 AS percentage_expenditure
FROM {NATION_SQL} n LEFT JOIN (SELECT n_name, year, total_value FROM {NATION_SQL} WHERE year >= 1997) e
  ON n.n_name = e.n_name AND n.year = e.year
""")
def edition2_roundtrip(spark, sf):
    """SRC2 + PRJ2/PRJ6/PRJ7 + JOI3: second-edition vocabulary, status dummies, millions, backfill join."""
    path = scratch_path(spark, "edition2")
    n = panels.nation_year_panel(spark, sf)
    dev = (F.col("share_finished") > 0.5).cast("int")
    e2 = n.select(F.col("n_name").alias("Country"), F.col("year").cast("string").alias("Year"),
                  dev.alias("Economy_status_Developed"), (1 - dev).alias("Economy_status_Developing"),
                  (F.col("n_orders") / 1000.0).alias("Population_mln"), F.col("avg_value").alias("Alcohol_consumption"),
                  F.col("n_regionkey").cast("string").alias("Region"))
    e2.write.mode("overwrite").option("header", True).csv(path)
    edition1 = n.filter(F.col("year") >= 1997).select(F.col("n_name").alias("country"), "year",
                                                      F.col("total_value").alias("percentage_expenditure"))
    back = SC.read_panel_edition2(spark, path, edition1=edition1, backfill_columns=("percentage_expenditure",))
    return rounded(back.drop("year_ts"))


@query("stream_scoring", oracle="""
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS sp, stddev_samp(value) AS ss FROM events)
SELECT event_id, round((value - m) / sp, 6) + 0.0 AS value,
       coalesce(abs(value - m) > 3 * ss, false) AS value_outlier
FROM events, s
""")
def stream_scoring(spark, sf):
    """Fitted scaler and z-score fences (batch) applied to the events table read as a file stream.

    The stream runs to completion (``availableNow``) into Parquet under the shared folder.
    """
    from ..operators import outliers as O
    from ..operators import scale as S
    from ..sources.tables import table
    from ..streaming.scoring import read_table_stream, run_to_parquet, score_stream

    ev = table(spark, sf, "events")
    scaler = S.fit_scaler(ev, ["value"])
    fences = O.zscore_fences(ev, ["value"], 3.0)
    out = score_stream(read_table_stream(spark, sf, "events"), keep=["event_id"], scaler=scaler, fences=fences)
    return rounded(run_to_parquet(out, scratch_path(spark, "stream-rows"), scratch_path(spark, "stream-ckpt")))
