"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Every shard owns ``vnodes`` places on a ring of 2^16 cells; a key belongs to the
next place clockwise of its hash.  No shard takes more rows than its capacity:
rows of an arc whose shard is full go on clockwise, place after place, until one
has room.  How many rows of an arc go where depends on the counts of the arcs
alone, a table of ``shards * vnodes`` rows whatever the size of the data; which
rows they are follows from their rank in the arc.

With ``slack`` 0 capacities differ by one at most and add up to the number of
rows, so counts are at most one apart (law ``rows``); with more slack a change
of the number of shards moves fewer rows.

A row's key is its id with the size and CRC of its text and its number among
the rows equal in all three, so that rows without id, under one repeated id, or
equal altogether spread over the ring like any others.  Ranks are taken inside
ring cells, 1/65536 of the rows each whatever their ids, and cells are added up
in two steps, so no task orders an arc, a shard or the table.

Defined cases: a null id hashes like any value; null text has size 1 and CRC 0;
repeated rows are numbered from 0 and have keys of their own; ties in hash are
ordered by id, size, CRC and number; only id and text are read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .mixing import numbered
from .store import written

VNODES = 64
CELLS = 1 << 16


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """``(cell, shard)`` of every place, clockwise; places of a shard stay when shards are added."""
    places: dict[int, tuple[bytes, int]] = {}
    for s in range(shards):
        for v in range(vnodes):
            digest = hashlib.sha256(f"{s}/{v}".encode()).digest()
            cell = int.from_bytes(digest[:2], "big")
            places[cell] = min(places.get(cell, (digest, s)), (digest, s))  # one place a cell
    return [(c, places[c][1]) for c in sorted(places)]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard."""
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [max(1, -(-int(rows * (1 + slack)) // shards))] * shards


def flows(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int]]:
    """``(arc, shard, from_rank, to_rank)``: where the rows of each arc go, by rank.

    In round ``k`` the rows still without a shard try the ``k``-th place
    clockwise of their arc; arcs come in ring order.
    """
    room, at, out = list(room), [0] * len(counts), []
    waiting = [a for a, n in enumerate(counts) if n]
    for k in range(len(counts)):
        still = []
        for a in waiting:
            s = owners[(a + k) % len(owners)]
            take = min(counts[a] - at[a], room[s])
            if take:
                out.append((a, s, at[a], at[a] + take))
                at[a] += take
                room[s] -= take
            if at[a] < counts[a]:
                still.append(a)
        waiting = still
        if not waiting:
            break
    return out


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from one literal."""
    literal = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(literal))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slack: float = 0.0,
           vnodes: int = VNODES) -> DataFrame:
    """``(key, size, text_crc32, shard, slot)``; slots count a shard's rows from 0 without gaps."""
    spark = docs.sparkSession
    places = ring(shards, vnodes)
    bare = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = docs.select(F.col(key).alias("id"), (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("size"),
                       F.crc32(bare).alias("crc"))
    rows = numbered(rows).withColumn("h", F.xxhash64(F.lit("ring"), "id", "size", "crc", "twin"))
    rows = written(rows.withColumn("cell", F.shiftrightunsigned("h", 48).cast("int")), "ring-rows")
    starts = [0, *(c + 1 for c, _ in places)]  # a cell belongs to the first place at or after it, around the ring
    stops = [*(c for c, _ in places), CELLS - 1]
    arcs = [{"arc": k % len(places), "lo": lo, "hi": hi} for k, (lo, hi) in enumerate(zip(starts, stops)) if lo <= hi]
    arc_of = _table(spark, arcs, "arc int, lo int, hi int").select("arc", F.explode(F.sequence("lo", "hi")).alias("a_cell"))
    in_arc = Window.partitionBy("arc").orderBy("cell")
    cells = (rows.groupBy("cell").agg(F.count("*").alias("n")).join(F.broadcast(arc_of), F.col("cell") == F.col("a_cell"))  # always 65536 rows
             .withColumn("before", F.sum("n").over(in_arc) - F.col("n")))
    cells = written(cells.select(F.col("cell").alias("c_cell"), "arc", "n", "before"), "ring-cells")
    found = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}  # a row an arc
    counts = [found.get(x, 0) for x in range(len(places))]
    moves = flows(counts, [s for _, s in places], capacities(sum(counts), shards, slack))
    base, spans = [0] * shards, []
    for arc, shard, lo, hi in sorted(moves):
        spans.append((arc, shard, lo, hi, base[shard] - lo))
        base[shard] += hi - lo
    by_arc: dict[int, dict] = {}
    for arc, shard, lo, hi, shift in spans:
        by_arc.setdefault(arc, {"s_arc": arc, "spans": []})["spans"].append({"shard": shard, "lo": lo, "hi": hi, "shift": shift})
    span_of = _table(spark, list(by_arc.values()), "s_arc int, spans array<struct<shard: int, lo: long, hi: long, shift: long>>")
    cell_info = cells.join(F.broadcast(span_of), F.col("arc") == F.col("s_arc")).select("c_cell", "before", "spans")
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("h", "id", "size", "crc", "twin")) - 1
    ranked = rows.withColumn("rank", rank).join(F.broadcast(cell_info), F.col("cell") == F.col("c_cell"))  # 65536 rows at most
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    span = F.element_at(F.filter("spans", lambda s: (F.col("rank") >= s["lo"]) & (F.col("rank") < s["hi"])), 1)
    return (ranked.withColumn("span", span)
            .select(F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.col("span.shard").alias("shard"),
                    (F.col("rank") + F.col("span.shift")).alias("slot")))
