"""Ordered statistics without an unpartitioned window (R6, WIN3, WIN6).

``global_index`` gives every row its 0-based position in a total order:
range-partition on the order keys (plus a hash of the row, and a row id so a
run of equal rows can still split), sort within partitions, count rows per partition
(one small aggregate: one row per partition), and add the partition's offset.
The range-sorted frame is checkpointed to the shared checkpoint folder first
so both passes see identical partitions even if an executor is lost.

``ordered_partition_stats`` computes order-dependent sums (Durbin-Watson
differences, Anderson-Darling rank sums) in ONE pass: each range partition
emits a handful of numbers plus its first/last values, and the driver
stitches the partition boundaries (number of partitions, not rows).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_POS_BITS = 33


def average_rank(df: DataFrame, score: str, partition_by: Sequence[str] = (), descending: bool = True,
                 name: str = "rank") -> DataFrame:
    """WIN3: rank with ties averaged = ``rank() + (ties - 1) / 2``.

    With ``partition_by`` each group is ranked independently; without it the
    frame must be small (k-sized tables) - use :func:`average_rank_of_all` for rows.
    """
    order = F.desc(score) if descending else F.asc(score)
    w = Window.partitionBy(*partition_by).orderBy(order)
    ties = Window.partitionBy(*partition_by, score)
    return df.withColumn(name, F.rank().over(w).cast("double") + (F.count(F.lit(1)).over(ties) - 1) / 2.0)


def _range_sorted(df: DataFrame, order: Sequence[str | Column], partitions: int | None) -> DataFrame:
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    # ties go by a hash of the row, the same in every run; the row id only splits runs of rows equal in all columns
    tie = F.struct(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("hash"), F.monotonically_increasing_id().alias("id"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("_tie", tie).repartitionByRange(n, *keys, F.col("_tie")).sortWithinPartitions(*keys, "_tie")


def global_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx",
                 partitions: int | None = None) -> DataFrame:
    """Add a 0-based global row index in ``order`` (ties broken by a row hash)."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = _range_sorted(df, order, partitions).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    counts = tagged.groupBy(pid.alias("_pid")).count().collect()  # one row per partition
    offsets, run = {}, 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets[r["_pid"]] = run
        run += r["count"]
    off_map = F.create_map(*[x for k, v in offsets.items() for x in (F.lit(k), F.lit(v))]) if offsets else None
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    idx = (off_map[pid] + pos) if off_map is not None else pos
    return tagged.withColumn(name, idx.cast("long")).drop("_mid", "_tie")


def ordered_partition_stats(df: DataFrame, order: Sequence[str | Column], value: str,
                            per_batch: Callable[[np.ndarray, int, float | None], dict[str, float]],
                            partitions: int | None = None) -> list[dict]:
    """Stream each range partition in global order through ``per_batch`` in one pass.

    ``per_batch(values, start, prev_last)`` gets an Arrow batch's values, the
    batch's 0-based position inside its partition and the previous batch's
    last value (None at a partition start); it returns additive sums.  Memory
    per task is one batch.  Returns one dict per non-empty partition, in
    global order, with ``_n``, ``_first`` and ``_last`` for boundary stitching.
    """
    cols = list(dict.fromkeys([*[c for c in order if isinstance(c, str)], value]))
    sorted_df = _range_sorted(df.select(*cols), order, partitions)
    keys = list(per_batch(np.array([0.0, 1.0]), 0, None).keys())

    def run(batches):
        from pyspark import TaskContext

        acc = dict.fromkeys(keys, 0.0)
        n, first, last = 0, None, None
        for b in batches:
            v = b[value].to_numpy(dtype=float)
            if v.size == 0:
                continue
            for k, x in per_batch(v, n, last).items():
                acc[k] += x
            first = v[0] if first is None else first
            last, n = v[-1], n + v.size
        if n:
            acc.update({"_pid": TaskContext.get().partitionId(), "_n": float(n), "_first": float(first),
                        "_last": float(last)})
            yield pd.DataFrame([acc])

    schema = ", ".join([f"`{k}` double" for k in keys] + ["_pid int", "_n double", "_first double", "_last double"])
    rows = sorted_df.mapInPandas(run, schema).collect()  # one row per partition
    return [r.asDict() for r in sorted(rows, key=lambda r: r["_pid"])]


def average_rank_of_all(df: DataFrame, score: str, descending: bool = True, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """WIN3 over a whole table: rank from 1 with ties averaged, without a window; a NULL or NaN score has no rank.

    Rows are sorted over range partitions, where a value with a third of the rows
    is many partitions.  One row a partition (its rows, and how many share its
    first and its last value) passes through the driver and says where the runs
    of equal values that cross partitions begin and end.  A forward scan then
    gives every row the place where its run begins, a backward one where it ends.
    """
    import pyarrow as pa

    ensure_checkpoint_dir(df.sparkSession)
    value = F.col(score).cast("double")
    source = df.withColumn("_v", F.when(~F.isnan(value), -value if descending else value))
    rows = source.where("_v IS NOT NULL")
    ordered = _range_sorted(rows, ["_v"], partitions).checkpoint()

    def runs(values: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.append(True, values[1:] != values[:-1]))

    def summary(batches):
        from pyspark import TaskContext

        n = n_first = n_last = 0
        first = last = None
        for b in batches:
            v = b.column(0).to_numpy()
            if not len(v):
                continue
            first = v[0] if first is None else first
            if v[0] == first:
                n_first += int((v == first).sum())
            tail = int((v == v[-1]).sum())
            n_last = n_last + tail if v[-1] == last else tail
            last, n = v[-1], n + len(v)
        if n:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "n": [n], "first": [float(first)], "n_first": [n_first],
                                              "last": [float(last)], "n_last": [n_last]})

    parts = sorted(ordered.select("_v").mapInArrow(summary, "part long, n long, first double, n_first long, last double, n_last long").collect(), key=lambda r: r["part"])
    begin, end, at = {}, {}, 0  # where the first run of a partition begins, and where its last run ends
    run, start = None, 0
    for r in parts:
        begin[r["part"]] = start if r["first"] == run else at
        if r["last"] != run:
            run, start = r["last"], at + r["n"] - r["n_last"]
        at += r["n"]
    run, stop = None, at
    for r in reversed(parts):
        end[r["part"]] = stop if r["last"] == run else at
        if r["first"] != run:
            run, stop = r["first"], at - r["n"] + r["n_first"]
        at -= r["n"]
    offset, total = {}, 0
    for r in parts:
        offset[r["part"]] = total
        total += r["n"]
    sizes = {r["part"]: r["n"] for r in parts}

    def scan(forward: bool):
        place = "_from" if forward else "_to"

        def run_batches(batches):
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            held, mark, seen = None, None, 0
            for b in batches:
                v = b.column(b.schema.get_field_index("_v")).to_numpy()
                if not len(v):
                    continue
                if held is None:
                    held, mark = v[0], begin[part] if forward else end[part]
                heads = runs(v)
                base = offset[part] + seen if forward else offset[part] + sizes[part] - seen
                marks = base + heads if forward else base - heads
                if v[0] == held:
                    marks[0] = mark
                out = np.repeat(marks, np.diff(np.append(heads, len(v))))
                held, mark, seen = v[-1], int(marks[-1]), seen + len(v)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*b.schema.names, place])

        return run_batches

    from pyspark.sql import types as T

    grown = T.StructType([*ordered.schema.fields, T.StructField("_from", T.LongType())])
    started = ordered.mapInArrow(scan(True), grown)
    ended = started.sortWithinPartitions(F.desc("_v")).mapInArrow(scan(False), T.StructType([*grown.fields, T.StructField("_to", T.LongType())]))
    ranked = ended.select(*df.columns, ((F.col("_from") + F.col("_to") + 1) / 2.0).alias(name))
    return ranked.unionAll(source.where("_v IS NULL").select(*df.columns, F.lit(None).cast("double").alias(name)))
