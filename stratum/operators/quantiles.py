"""Exact quantiles by digit refinement (AGG4, AGG6, AGG10, AGG11, AGG15, AGG19, OUT1, OUT6, CHD2, CHD8, CLN3, CLN4).

A double becomes a 64-bit integer in the same order.  Counting its leading
digit per (group, column) tells in which digit each wanted rank lies; counting
the next digit among the rows that share it, and the last, gives the exact
value.  The keys are written once as narrow rows; then three scans of them, each an ordinary distributed count with map-side partial
aggregation: no value map of a column, no sort of the rows, and the same path
for any number of rows, groups or distinct values.  A digit has at most 2^22
values, which bounds every running total.

The result is a table; per-group quantiles never pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path

#: bits left below the digits counted so far, after each scan
_REST = (42, 21, 0)
_LOW = np.int64(0x7FFFFFFFFFFFFFFF)


def ordered_bits(v: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles (-0.0 counts as 0.0)."""
    bits = (v + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ _LOW, bits)


def from_ordered_bits(bits: np.ndarray) -> np.ndarray:
    """Inverse of :func:`ordered_bits`."""
    return np.where(bits < 0, bits ^ _LOW, bits).astype(np.int64).view(np.float64)


def _keys(df: DataFrame, columns: Sequence[str], by: str | None) -> DataFrame:
    """``(g, f, key)``: every value present, as an ordered integer."""
    source = df.select((F.col(by) if by else F.lit(0)).alias("g"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    source = source.where(F.col("g").isNotNull())
    schema = T.StructType([T.StructField("g", source.schema["g"].dataType), T.StructField("f", T.IntegerType()), T.StructField("key", T.LongType())])

    def run(batches):
        for b in batches:
            for i in range(len(columns)):
                v = b.column(1 + i).to_numpy(zero_copy_only=False).astype(float)
                at = np.flatnonzero(~np.isnan(v))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(np.full(len(at), i, np.int32)), pa.array(ordered_bits(v[at]))], names=["g", "f", "key"])

    return source.mapInArrow(run, schema)


def _stage(df: DataFrame, paths: list[str]) -> DataFrame:
    """A table between two scans, written so that a lost executor costs nothing."""
    spark = df.sparkSession
    paths.append(scratch_path(spark, "quantiles"))
    df.write.parquet(paths[-1])
    return spark.read.schema(df.schema).parquet(paths[-1])


def _located(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the digit that holds its rank, and the rank within it."""
    order = Window.partitionBy("g", "f", "prefix").orderBy("digit")
    running = counts.withColumn("upto", F.sum("n").over(order)).select(
        F.col("g").alias("cg"), F.col("f").alias("cf"), F.col("prefix").alias("cp"), "digit", "n", "upto")
    hit = ((F.col("g") == F.col("cg")) & (F.col("f") == F.col("cf")) & (F.col("prefix") == F.col("cp"))
           & (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    return wanted.join(running, hit).select("g", "f", "p", "side", "frac", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"),
                                            F.col("digit").alias("prefix"))


def _exact(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None, paths: list[str]) -> DataFrame:
    """``(g, f, p, value)``: position of the column and of the probability, and the quantile."""
    keys = _stage(_keys(df, columns, by), paths)  # the source is read and derived once
    first = _stage(keys.groupBy("g", "f", F.shiftright("key", _REST[0]).alias("digit")).agg(F.count("*").alias("n"))
                   .withColumn("prefix", F.lit(0).cast("long")), paths)
    h = (F.col("total") - 1) * F.col("prob")
    asked = F.explode(F.array(*[F.struct(F.lit(i).alias("p"), F.lit(float(p)).alias("prob")) for i, p in enumerate(probs)])).alias("a")
    total = first.groupBy("g", "f").agg(F.sum("n").alias("total")).select("g", "f", "total", asked).select("g", "f", "total", "a.*")
    ranked = total.select("g", "f", "p", (h - F.floor(h)).alias("frac"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.floor(h).alias("rank")),
        F.struct(F.lit(1).alias("side"), F.least(F.floor(h) + 1, F.col("total") - 1).alias("rank")))).alias("r"))
    wanted = ranked.select("g", "f", "p", "r.side", "frac", "r.rank", F.lit(0).cast("long").alias("prefix"))
    wanted = _stage(_located(first, wanted), paths)
    for above, rest in zip(_REST, _REST[1:]):
        open_ = wanted.select(F.col("g").alias("wg"), F.col("f").alias("wf"), F.col("prefix").alias("wp")).distinct()
        inside = keys.withColumn("prefix", F.shiftright("key", above)).join(
            open_, (F.col("g") == F.col("wg")) & (F.col("f") == F.col("wf")) & (F.col("prefix") == F.col("wp")))
        counts = inside.groupBy("g", "f", "prefix", F.shiftright("key", rest).alias("digit")).agg(F.count("*").alias("n"))
        wanted = _stage(_located(counts, wanted), paths)

    def decode(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(from_ordered_bits(b.column(5).to_numpy()))],
                                             names=["g", "f", "p", "side", "frac", "v"])

    schema = T.StructType([*(wanted.schema[n] for n in ("g", "f", "p", "side", "frac")), T.StructField("v", T.DoubleType())])
    values = wanted.select("g", "f", "p", "side", "frac", "prefix").mapInArrow(decode, schema)
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("v")))
    return values.groupBy("g", "f", "p").agg(side(0).alias("lo"), side(1).alias("hi"), F.max("frac").alias("frac")).select(
        "g", "f", "p", (F.col("lo") + F.col("frac") * (F.col("hi") - F.col("lo"))).alias("value"))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles (numpy 'linear') of whole columns; None where a column has no value."""
    columns = list(columns)
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    if not columns:
        return out
    paths: list[str] = []
    try:
        for r in _exact(df, columns, probs, None, paths).collect():  # columns x probabilities numbers
            out[columns[r["f"]]][r["p"]] = r["value"]
    finally:
        for p in paths:
            drop_path(df.sparkSession, p)
    return out


def grouped_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str) -> DataFrame:
    """``(by, q{column}_{prob})``: a row per group, quantile columns by position; NULL where a group has no value."""
    paths: list[str] = []
    found = _exact(df, list(columns), probs, by, paths)
    for p in paths[:-1]:  # the last table is what the result reads
        drop_path(df.sparkSession, p)
    picks = [F.max(F.when((F.col("f") == i) & (F.col("p") == j), F.col("value"))).alias(f"q{i}_{j}")
             for i in range(len(columns)) for j in range(len(probs))]
    return found.groupBy(F.col("g").alias(by)).agg(*picks)
