"""Ordered scans per entity that split hot entities (CLN1, WIN1, WIN2).

Rows are range-partitioned by (entity, time, row hash), so an entity with a
third of all rows is many partitions.  A first pass keeps, for each partition,
its last row or its last present values; a second streams the partitions, each
beginning with what the one before left over.  What passes through the driver
is one row a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def _ordered(df: DataFrame, entity: str, time: str) -> DataFrame:
    """``df`` sorted over range partitions; ties in time are ordered by a hash of the row, the same in every run."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    keys = [F.col(entity).asc_nulls_first(), F.col(time).asc_nulls_first(), F.col("_tie")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tagged.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint()


def _leftovers(ordered: DataFrame, entity: str, time: str, columns: Sequence[str], present_only: bool) -> dict[int, dict[str, tuple]]:
    """For each partition and column: entity and value that the partitions before it end with."""
    place = F.struct(F.col(entity).isNotNull().alias("has"), F.col(entity).alias("e"), F.col(time).isNotNull().alias("timed"),
                     F.col(time).alias("at"), F.col("_tie").alias("tie"))
    lasts = [F.max_by(F.struct(F.col(entity).alias("e"), F.col(f"`{c}`").alias("v")),
                      F.when(F.col(f"`{c}`").isNotNull(), place) if present_only else place).alias(f"c{i}") for i, c in enumerate(columns)]
    rows = ordered.groupBy(F.spark_partition_id().alias("part")).agg(*lasts).collect()  # one row a partition
    held: dict[str, tuple] = {}
    out: dict[int, dict[str, tuple]] = {}
    for r in sorted(rows, key=lambda r: r["part"]):
        out[r["part"]] = dict(held)
        for i, c in enumerate(columns):
            if r[f"c{i}"] is not None:
                held[c] = (r[f"c{i}"]["e"], r[f"c{i}"]["v"])
    return out


def _segments(entities: pa.Array) -> np.ndarray:
    """Position where the run of equal entities that each row is in begins."""
    codes = entities.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    fresh = np.append(True, codes[1:] != codes[:-1])
    return np.maximum.accumulate(np.where(fresh, np.arange(len(codes)), 0))


def _take(column: pa.Array, at: np.ndarray, before, begins: np.ndarray, same: bool) -> pa.Array:
    """``column[at]``; where ``at`` lies before the row's run, ``before`` for the first run of a continued entity, else null."""
    inside = at >= begins
    taken = column.take(pa.array(np.where(inside, at, 0), mask=~inside))
    if same and before is not None:
        first = ~inside & (begins == 0)
        if first.any():
            taken = pc.if_else(pa.array(first), pa.scalar(before, column.type), taken)
    return taken


def _scan(df: DataFrame, entity: str, time: str, columns: Sequence[str], names: Sequence[str], fill: bool) -> DataFrame:
    """Streams ``columns`` into ``names``: carried forward (``fill``) or lagged by one row."""
    ordered = _ordered(df, entity, time)
    left = _leftovers(ordered, entity, time, columns, present_only=fill)
    kept = list(df.columns)
    fields = {f.name: T.StructField(f.name, f.dataType) for f in df.schema.fields}
    for c, n in zip(columns, names):
        fields[n] = T.StructField(n, df.schema[c].dataType)

    def run(batches):
        from pyspark import TaskContext

        held = dict(left.get(TaskContext.get().partitionId(), {}))
        for b in batches:
            if not b.num_rows:
                continue
            data = {c: b.column(b.schema.get_field_index(c)) for c in kept}
            entities = data[entity]
            begins, row = _segments(entities), np.arange(b.num_rows)
            first, last = entities[0].as_py(), entities[b.num_rows - 1].as_py()
            made = {}
            for c, n in zip(columns, names):
                e, v = held.get(c, (None, None))
                same = c in held and e == first
                column = data[c]
                present = column.is_valid().to_numpy(zero_copy_only=False)
                at = np.maximum.accumulate(np.where(present, row, -1)) if fill else row - 1
                made[n] = _take(column, at, v, begins, same)
                tail = made[n][b.num_rows - 1].as_py() if fill else column[b.num_rows - 1].as_py()
                held[c] = (last, tail)
            yield pa.RecordBatch.from_arrays([made.get(f, data.get(f)) for f in fields], names=list(fields))

    return ordered.drop("_tie").mapInArrow(run, T.StructType(list(fields.values())))


def filled_forward(df: DataFrame, entity: str, time: str, columns: Sequence[str]) -> DataFrame:
    """The last present value of each column so far, per entity in time order."""
    return _scan(df, entity, time, columns, columns, fill=True)


def previous_row(df: DataFrame, entity: str, time: str, column: str, name: str) -> DataFrame:
    """The value of the row before, per entity in time order."""
    return _scan(df, entity, time, [column], [name], fill=False)
