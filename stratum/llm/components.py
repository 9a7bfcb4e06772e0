"""Connected components of an edge table by alternating large and small stars.

Each round is two joins with per-node minima; the edges shrink to stars around
the smallest node of each component.  Every round is written to the shared
folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("n"), F.least("u", "low").alias("low"))
    return (both.where("v > u").join(low, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them; edges point downwards."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(low.withColumnRenamed("u", "n"), F.col("u") == F.col("n")).where("v <> low").select(
        F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionAll(low.select("u", F.col("low").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one node, which points to none: such stars are the components."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, label)``: every node of ``edges(u, v)`` with the smallest node of its component.

    Loops and repeated edges are ignored; an empty table gives an empty result.
    A round keeps components as they are, so the first star forest is the result.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    while not _settled(now):
        now = written(_small_star(_large_star(now)), name)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
