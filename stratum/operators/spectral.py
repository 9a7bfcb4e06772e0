"""Spectral clusters of all rows on a nearest-neighbour graph (CLU7).

Neighbours.  Rows are dealt to the cells of a balanced tree, whose splits come
from a bounded sample (64 rows a cell); cells that come out large are dealt out
further by a hash.  A row's ``k`` nearest in its own cell bound the distance of
its true neighbours; the cells whose box is nearer than that, and no others, are
searched for it too.  So the neighbours are exact, though few pairs are compared:
in its task a cell is halved on down to ``LEAF`` rows, which are compared in full
unless their box is too far.  Rows that have ``k`` equal ones go nowhere else.
Nothing depends on the number of partitions.

Embedding.  ``W`` joins each row to its neighbours (1 if both found each other,
else 1/2).  The top eigenvectors of ``(I + D^-1/2 W D^-1/2) / 2`` come from
subspace iteration with a few vectors more than asked for.  The links lie packed
by blocks of ids, and so do the vectors: a round sends a block's vectors to its
links, in one place since the start, and sums to the blocks they lead to, then the
Gram of the new vectors, whose eigenvectors give values and an orthonormal block.  The first block is the eigenvectors of the
graph between the rows' clustering features, which is small enough to solve at
once, so that few rounds are left.  The rows of the embedding, scaled by
``D^-1/2``, are clustered by k-means to convergence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, drop_path, scratch_path
from . import lloyd as KM
from . import ward as WD
from .rank import global_index

NEIGHBORS = 10
CELL = 8192
MOST_CELLS = 1 << 14
LEAF = 128
SAMPLE = 64
#: ids of a packed block and links of a tile at most, and blocks that smaller tables make
BLOCK = 1 << 16
LINKS = 1 << 21
BLOCKS = 64
EXTRA = 4
TOL = 1e-6
MAX_ROUNDS = 200


@dataclass
class _Cells:
    """A balanced tree of halvings along axes; node ``i`` has ``2 i + 1`` (up to ``at``) and ``2 i + 2``, its box is ``lo`` to ``hi``."""

    axis: np.ndarray
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    #: by cell, into how many parts a hash of the row deals its rows
    parts: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(len(self.at).bit_length()):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.axis[node]] > self.at[node])
        return node - len(self.at)

    def part_of(self, ids: np.ndarray, cell: np.ndarray) -> np.ndarray:
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(33)) % self.parts[cell].astype(np.uint64)).astype(np.int64)

    def within(self, x: np.ndarray, r2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows with each part of each cell whose box is nearer than the root of ``r2``."""
        row, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        for _ in range(len(self.at).bit_length()):
            row, node = np.concatenate([row, row]), np.concatenate([2 * node + 1, 2 * node + 2])
            near = _box_d2(x[row], self.lo[node], self.hi[node]) < r2[row]
            row, node = row[near], node[near]
        cell = node - len(self.at)
        times = self.parts[cell]
        first = np.repeat(np.cumsum(times) - times, times)
        return np.repeat(row, times), np.repeat(cell, times), np.arange(int(times.sum())) - first


def _box_d2(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distances from rows to boxes, summed as those of rows are: never above that of a row in the box."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += np.maximum(np.maximum(lo[..., j] - x[:, j], x[:, j] - hi[..., j]), 0.0) ** 2
    return out


def _halving(x: np.ndarray) -> tuple[int, float, float]:
    """Axis and value that part rows (up to the value, above it), and the share of the smaller side: the widest axis that leaves 3 of 10 on it, or the best."""
    best = 0, 0.0, -1.0
    for j in np.argsort(-x.std(axis=0), kind="stable").tolist():
        v = np.sort(x[:, j])
        middle = v[(len(v) - 1) // 2]
        below = int(np.searchsorted(v, middle, "left"))  # equal values stay together: part before or after those in the middle
        for at in (middle, v[below - 1]) if below else (middle,):
            left = int(np.searchsorted(v, at, "right"))
            share = min(left, len(v) - left) / len(v)
            if share > best[2]:
                best = j, float(at), share
        if best[2] >= 0.3:
            break
    return best


def _cells(points: DataFrame, n: int, d: int, seed: int) -> _Cells:
    """Cells of about ``CELL`` rows, from 64 sampled rows a cell at most."""
    levels = max(0, int(np.ceil(np.log2(min(MOST_CELLS, max(1, n // CELL))))))
    sample = points.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE << levels).toArrow()
    x = KM.vectors(sample["x"].combine_chunks())
    inner = (1 << levels) - 1
    axis, at = np.zeros(inner, dtype=np.int64), np.zeros(inner)
    lo, hi = np.full((2 * inner + 1, d), -np.inf), np.full((2 * inner + 1, d), np.inf)
    held = {0: np.arange(len(x))}
    for i in range(inner):
        rows = held.pop(i)
        if len(rows):
            axis[i], at[i], _ = _halving(x[rows])
        right = x[rows, axis[i]] > at[i]
        held[2 * i + 1], held[2 * i + 2] = rows[~right], rows[right]
        lo[2 * i + 1:2 * i + 3], hi[2 * i + 1:2 * i + 3] = lo[i], hi[i]
        hi[2 * i + 1, axis[i]] = lo[2 * i + 2, axis[i]] = at[i]
    cells = _Cells(axis, at, lo, hi, np.ones(inner + 1, dtype=np.int64))
    if levels:
        most = 4 * max(CELL, n // MOST_CELLS)
        for r in _dealt(points, cells, d).groupBy("cell").count().collect():  # a row a cell
            cells.parts[r["cell"]] = -(-r["count"] // most)
    else:
        cells.parts[0] = -(-n // (4 * CELL))
    return cells


def _dealt(points: DataFrame, cells: _Cells, d: int) -> DataFrame:
    sent = points.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = KM.vectors(batch.column(1)) if batch.num_rows else np.zeros((0, d))
            cell = sent.value.of(x)
            part = sent.value.part_of(batch.column(0).to_numpy(), cell)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(part)], names=["id", "x", "cell", "part"])

    return points.select("id", "x").mapInArrow(run, "id long, x array<double>, cell long, part long")


def _d2(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d += (x[:, j:j + 1] - y[:, j]) ** 2
    return d


_Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def _by_leaves(q: np.ndarray, qx: np.ndarray, r2: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> _Found:
    """For each query its ``k`` nearest of the rows (itself excepted) that are nearer than the root of ``r2``: place of the query, row, distance.

    The rows are halved down to ``LEAF``; the nearest leaf bounds the distance, and others are compared if their box is nearer than that.
    """
    todo, leaves = [np.argsort(ids)], []
    while todo:
        rows = todo.pop()
        if len(rows) > LEAF:
            axis, at, share = _halving(x[rows])
            right = x[rows, axis] > at if share > 0 else np.arange(len(rows)) >= len(rows) // 2  # equal rows split too
            todo += [rows[~right], rows[right]]
        elif len(rows):
            leaves.append(rows)
    boxes = [(x[rows].min(axis=0), x[rows].max(axis=0)) for rows in leaves]
    home, least = np.zeros(len(q), dtype=np.int64), np.full(len(q), np.inf)
    for i, box in enumerate(boxes):
        d = _box_d2(qx, *box)
        nearer = d < least
        home[nearer], least[nearer] = i, d[nearer]
    bound = r2.copy()
    out: list[_Found] = []

    def compare(here: np.ndarray, rows: np.ndarray, first: bool) -> None:
        for lo in range(0, len(here), LEAF * 4):
            some = here[lo:lo + LEAF * 4]
            d = _d2(qx[some], x[rows])
            d[q[some, None] == ids[rows]] = np.inf
            if first and len(rows) > k:
                at = np.argsort(d, axis=1, kind="stable")[:, :k]
                near = np.take_along_axis(d, at, axis=1)
                ok = near < bound[some, None]
                out.append((np.repeat(some, ok.sum(axis=1)), ids[rows][at[ok]], near[ok]))
                bound[some] = np.minimum(bound[some], near[:, -1])
            else:
                a, b = np.nonzero(d < bound[some, None])
                out.append((some[a], ids[rows][b], d[a, b]))

    for i, rows in enumerate(leaves):
        compare(np.flatnonzero(home == i), rows, True)
    for i, (rows, box) in enumerate(zip(leaves, boxes)):
        compare(np.flatnonzero((home != i) & (_box_d2(qx, *box) < bound)), rows, False)
    return _first(out, k)


def _by_all(q: np.ndarray, qx: np.ndarray, r2: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, block: int) -> _Found:
    """As :func:`_by_leaves`, by comparing every query with every row."""
    out: list[_Found] = []
    for lo in range(0, len(q), 512):
        some = np.arange(lo, min(lo + 512, len(q)))
        for at in range(0, len(x), block):
            d = _d2(qx[some], x[at:at + block])
            d[q[some, None] == ids[at:at + block]] = np.inf
            near = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
            value = np.take_along_axis(d, near, axis=1)
            ok = value < r2[some, None]
            out.append((np.repeat(some, ok.sum(axis=1)), ids[at + near[ok]], value[ok]))
    return _first(out, k)


def _first(found: list[_Found], k: int) -> _Found:
    """The ``k`` nearest of each query, in order of query, distance and row."""
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    q, to, d2 = (np.concatenate(v) for v in zip(*found))
    order = np.lexsort((to, d2, q))
    q, to, d2 = q[order], to[order], d2[order]
    start = np.flatnonzero(np.diff(q, prepend=-1))
    place = np.arange(len(q)) - np.repeat(start, np.diff(start, append=len(q)))
    return q[place < k], to[place < k], d2[place < k]


def _nearest(edges: DataFrame, k: int, by: str = "src", other: str = "dst") -> DataFrame:
    order = Window.partitionBy(by).orderBy("d2", other)
    return edges.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


_EDGE = "src long, dst long, d2 double"


def _search(points: DataFrame, asked: DataFrame, k: int, seed: int, near: Callable[..., _Found]) -> DataFrame:
    """``(src, dst, d2)``: the ``k`` nearest of ``points`` for each row of ``asked`` (id, x), exactly.

    A query meets the rows of its own cell first.  The distance it then has tells
    which other cells may hold a nearer row: it meets the rows of these too.
    """
    first = points.first()
    if first is None:
        return points.sparkSession.createDataFrame([], _EDGE)
    n, d = points.count(), len(first["x"])
    cells = _cells(points, n, d, seed)
    sent = points.sparkSession.sparkContext.broadcast(cells)
    # few bytes, but much work: their partitions must not be put together
    spread = lambda df: df.repartition(max(1, min(len(cells.at) + 1, most)), "cell", "part")
    most = 4 * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = spread(_dealt(points, cells, d))
    own = spread(_dealt(asked, cells, d).withColumn("r2", F.lit(float("inf"))))

    def met(queries: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, _Found]:
        q, r2 = queries["id"].to_numpy(), queries["r2"].to_numpy()
        qx = KM.vectors(queries["x"].combine_chunks()) if len(q) else np.zeros((0, d))
        x = KM.vectors(rows["x"].combine_chunks()) if rows.num_rows else np.zeros((0, d))
        return q, qx, r2, near(q, qx, r2, rows["id"].to_numpy(), x, k) if len(q) and len(x) else _first([], k)

    def edges(queries: pa.Table, rows: pa.Table) -> pa.Table:
        q, _, _, (at, to, d2) = met(queries, rows)
        return pa.table({"src": q[at], "dst": to.astype(np.int64), "d2": d2})

    def visits(queries: pa.Table, rows: pa.Table) -> pa.Table:
        q, x, r2, (at, _, d2) = met(queries, rows)
        full = np.bincount(at, minlength=len(q)) >= k
        far = np.zeros(len(q))
        np.maximum.at(far, at, d2)
        r2 = np.where(full, far, r2)
        row, cell, part = sent.value.within(x, r2)
        if len(q):
            other = (cell != queries["cell"][0].as_py()) | (part != queries["part"][0].as_py())
            row, cell, part = row[other], cell[other], part[other]
        return pa.table({"id": q[row], "x": pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * d), pa.array(x[row].ravel())), "cell": cell, "part": part, "r2": r2[row]})

    pair = lambda queries: queries.groupBy("cell", "part").cogroup(held.groupBy("cell", "part"))
    away = pair(own).applyInArrow(visits, "id long, x array<double>, cell long, part long, r2 double")
    return _nearest(pair(own).applyInArrow(edges, _EDGE).unionAll(pair(spread(away)).applyInArrow(edges, _EDGE)), k)


def neighbors(points: DataFrame, k: int = NEIGHBORS, seed: int = 0) -> DataFrame:
    """``(src, dst, d2)``: the ``k`` nearest rows of every row of ``points`` (id, x)."""
    return _search(points, points, k, seed, _by_leaves)


def exact_neighbors(points: DataFrame, asked: DataFrame, k: int = NEIGHBORS, block: int = 4096) -> DataFrame:
    """``(src, dst, d2)``: the ``k`` nearest rows by comparing the query rows ``asked`` (id, x) with every row of the cells that may hold one, block by block.

    Its cells are others than those of :func:`neighbors`, and nothing in a cell is left out.
    """
    return _search(points, asked, k, 1, lambda *args: _by_all(*args, block))


def recall(points: DataFrame, edges: DataFrame, asked: DataFrame, k: int = NEIGHBORS) -> float:
    """Share of the true ``k`` nearest distances of the query rows that their found neighbours reach."""
    true = exact_neighbors(points, asked, k)
    limit = true.groupBy(F.col("src").alias("t_src")).agg(F.max("d2").alias("limit"), F.count("*").alias("n"))
    found = edges.join(limit, F.col("src") == F.col("t_src")).where(F.col("d2") <= F.col("limit") * (1 + 1e-12)).count()
    return found / max(1, true.count())


def both_ways(edges: DataFrame) -> DataFrame:
    """``(src, dst, w)``: half a link each way for every edge."""
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.select(F.inline(ways)).withColumn("w", F.lit(0.5))


def graph(edges: DataFrame) -> DataFrame:
    """``(src, dst, w)`` both ways with ``w`` = 1 for rows that found each other, else 1/2."""
    return both_ways(edges).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def _bytes(v: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(v, dtype=kind).tobytes()


def _of(rows: pa.Table, name: str, kind: str, i: int = 0) -> np.ndarray:
    return np.frombuffer(rows[name][i].as_buffer(), dtype=kind)


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


_LONG, _BIN = pa.int64(), pa.binary()
_ROWS_OF = "block long, at binary, feature binary"
_TILE = "block long, part long, src binary, start binary, dst binary, own binary, w binary"
_SENT = "block long, part long, origin long, at binary, deg binary, v binary"
_HELD = "block long, at binary, deg binary, v binary, gram binary"


def _to_blocks(ids: np.ndarray, width: int) -> Iterator[tuple[int, slice]]:
    """Blocks of sorted ids, and where each lies."""
    block = ids // width
    first = np.flatnonzero(np.diff(block, prepend=block[:1] - 1))
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(ids)]):
        yield int(block[lo]), slice(lo, hi)


class _Packed:
    """The graph as tiles: the links that lead to the rows of a block, ``LINKS`` of them at most unless one source has more.

    Block ``b`` has the rows of ids ``b * width`` to ``(b + 1) * width - 1``.  A product with a block of vectors, packed
    likewise, is one pass over the tiles; what shuffles is a sum for each row and each block that links to it.
    """

    def __init__(self, links: DataFrame, features: DataFrame):
        self.spark = links.sparkSession
        span = features.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"), F.max("feature").alias("f")).first()
        n = span["n"]
        self.size = 1 + (span["f"] if n else -1)
        blocks = max(1, -(-n // max(BLOCK // 16, min(BLOCK, n // BLOCKS))))
        self.width = width = max(1, -(-(span["hi"] - span["lo"] + 1) // blocks)) if n else 1
        self.tasks = max(1, min(blocks, 4 * int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        block = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
        parts = (links.groupBy(block("dst").alias("p_block")).count().select("p_block", F.ceil(F.col("count") / LINKS).alias("parts"))
                 .where("parts > 1").collect())  # blocks whose rows are linked by far more rows than others'
        self.parts = F.broadcast(self.spark.createDataFrame([tuple(r) for r in parts], "p_block long, parts long"))
        keyed = self._parted(links.withColumn("block", block("dst"))).withColumn("part", F.pmod(F.xxhash64("src"), F.col("parts"))).select("block", "part", "src", "dst", "w")
        tiles = self._spread(keyed).groupBy("block", "part").applyInArrow(self._tile(), _TILE)
        self.tiles = checkpointed(self._spread(tiles))
        self.rows = checkpointed(features.select(block("id").alias("block"), "id", "feature").groupBy("block").applyInArrow(self._packed(), _ROWS_OF))

    def _parted(self, df: DataFrame) -> DataFrame:
        return df.join(self.parts, F.col("block") == F.col("p_block"), "left").drop("p_block").withColumn("parts", F.coalesce("parts", F.lit(1)))

    def _spread(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.tasks, "block", "part")

    def _met(self, held: DataFrame):
        """Every tile with the packed rows of its block; the first part's task also has the block's own rows to hand on."""
        every = self._parted(held).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        return self._spread(every).groupBy("block", "part").cogroup(self.tiles.groupBy("block", "part"))

    def _tile(self) -> Callable[[pa.Table], pa.Table]:
        width = self.width
        schema = pa.schema([("block", _LONG), ("part", _LONG), *((c, _BIN) for c in ("src", "start", "dst", "own", "w"))])

        def run(links: pa.Table) -> pa.Table:
            src, dst, w = (links[c].to_numpy() for c in ("src", "dst", "w"))
            block = links["block"][0].as_py()
            dst = dst - block * width
            first = int(src.min())
            if (int(src.max()) - first + 1) < (1 << 62) // width:  # one key: a faster sort than by two
                key = (src - first) * width + dst
                order = np.argsort(key)
                new = np.flatnonzero(np.diff(key[order], prepend=-1))
            else:
                order = np.lexsort((dst, src))
                new = np.flatnonzero((np.diff(src[order], prepend=first - 1) != 0) | (np.diff(dst[order], prepend=-1) != 0))
            src, dst, w = src[order[new]], dst[order[new]], np.add.reduceat(w[order], new)
            start = np.flatnonzero(np.diff(src, prepend=first - 1))
            if width <= 4 * BLOCK:
                held = np.zeros(width, dtype=bool)
                held[dst] = True
                at, own = np.flatnonzero(held), (np.cumsum(held) - 1)[dst]
            else:
                at, own = np.unique(dst, return_inverse=True)
            return _table([{"block": block, "part": links["part"][0].as_py(), "src": _bytes(src[start], "<i8"), "start": _bytes(start, "<i8"),
                            "dst": _bytes(at, "<i8"), "own": _bytes(own, "<i4"), "w": _bytes(w, "<f8")}], schema)

        return run

    def _packed(self) -> Callable[[pa.Table], pa.Table]:
        width = self.width
        schema = pa.schema([("block", _LONG), ("at", _BIN), ("feature", _BIN)])

        def run(rows: pa.Table) -> pa.Table:
            ids, block = rows["id"].to_numpy(), rows["block"][0].as_py()
            order = np.argsort(ids)
            return _table([{"block": block, "at": _bytes(ids[order] - block * width, "<i8"), "feature": _bytes(rows["feature"].to_numpy()[order], "<i8")}], schema)

        return run

    def coarse(self) -> tuple[DataFrame, np.ndarray]:
        """Every block's rows with their degree, and the links' weights summed by the features of both ends."""
        width, size = self.width, self.size
        message = pa.schema([("block", _LONG), ("origin", _LONG), ("at", _BIN), ("b", _BIN), ("w", _BIN)])
        summed = pa.schema([("block", _LONG), ("at", _BIN), ("feature", _BIN), ("deg", _BIN), ("pair", _BIN), ("w", _BIN)])

        def send(rows: pa.Table, tile: pa.Table) -> pa.Table:
            out = []
            if rows.num_rows and tile.num_rows:
                src, start, dst, own, w = (_of(tile, c, k) for c, k in (("src", "<i8"), ("start", "<i8"), ("dst", "<i8"), ("own", "<i4"), ("w", "<f8")))
                feature = _of(rows, "feature", "<i8")[np.searchsorted(_of(rows, "at", "<i8"), dst)][own]
                from_ = np.repeat(np.arange(len(src)), np.diff(start, append=len(w)))
                pair, to = np.unique(from_ * size + feature, return_inverse=True)
                total, ids = np.bincount(to, w), src[pair // size]
                for block, some in _to_blocks(ids, width):
                    out.append({"block": block, "origin": rows["block"][0].as_py(), "at": _bytes(ids[some] - block * width, "<i8"), "b": _bytes(pair[some] % size, "<i4"), "w": _bytes(total[some], "<f8")})
            return _table(out, message)

        def add(rows: pa.Table, sent: pa.Table) -> pa.Table:
            if not rows.num_rows or not sent.num_rows:  # rows without links belong to no graph
                return summed.empty_table()
            at, feature = _of(rows, "at", "<i8"), _of(rows, "feature", "<i8")
            order = np.argsort(sent["origin"].to_numpy(), kind="stable").tolist()
            to = np.searchsorted(at, np.concatenate([_of(sent, "at", "<i8", i) for i in order]))
            w = np.concatenate([_of(sent, "w", "<f8", i) for i in order])
            deg = np.bincount(to, w, minlength=len(at))
            pair, place = np.unique(feature[to] * size + np.concatenate([_of(sent, "b", "<i4", i) for i in order]), return_inverse=True)
            linked = deg > 0
            return _table([{"block": rows["block"][0].as_py(), "at": _bytes(at[linked], "<i8"), "feature": _bytes(feature[linked], "<i8"), "deg": _bytes(deg[linked], "<f8"),
                            "pair": _bytes(pair, "<i8"), "w": _bytes(np.bincount(place, w), "<f8")}], summed)

        sent = self._met(self.rows).applyInArrow(send, "block long, origin long, at binary, b binary, w binary")
        rows = checkpointed(self.rows.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(add, "block long, at binary, feature binary, deg binary, pair binary, w binary"))

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    pair = _of(batch, "pair", "<i8", i)
                    yield pa.RecordBatch.from_arrays([pa.array(pair // size), pa.array(pair % size), pa.array(_of(batch, "w", "<f8", i))], names=["a", "b", "w"])

        found = rows.select("pair", "w").mapInArrow(pairs, "a long, b long, w double").groupBy("a", "b").agg(F.sum("w").alias("w")).toArrow()  # pairs of features
        w = np.zeros((size, size))
        w[found["a"].to_numpy(), found["b"].to_numpy()] = found["w"].to_numpy()
        return rows.drop("pair", "w"), w

    def start(self, rows: DataFrame, by_feature: np.ndarray) -> DataFrame:
        """The block whose rows are those of ``by_feature`` times the root of the degree."""
        sent = self.spark.sparkContext.broadcast(by_feature)

        def run(rows: pa.Table) -> pa.Table:
            deg = _of(rows, "deg", "<f8")
            return _held(rows["block"][0].as_py(), _of(rows, "at", "<i8"), deg, sent.value[_of(rows, "feature", "<i8")] * np.sqrt(deg)[:, None])

        return rows.groupBy("block").applyInArrow(run, _HELD)

    def times(self, held: DataFrame, turn: np.ndarray) -> DataFrame:
        """``(I + D^-1/2 W D^-1/2) / 2`` times the block ``held`` times ``turn``."""
        width, k = self.width, len(turn)
        message = pa.schema([("block", _LONG), ("part", _LONG), ("origin", _LONG), ("at", _BIN), ("deg", _BIN), ("v", _BIN)])

        def send(rows: pa.Table, tile: pa.Table) -> pa.Table:
            if not rows.num_rows:
                return message.empty_table()
            here, part = rows["block"][0].as_py(), rows["part"][0].as_py()
            at, deg = _of(rows, "at", "<i8"), _of(rows, "deg", "<f8")
            root = np.sqrt(deg)[:, None]
            x = _of(rows, "v", "<f8").reshape(-1, k) @ turn
            kept, out = x * root, []
            if tile.num_rows:
                src, start, dst, own, w = (_of(tile, c, kind) for c, kind in (("src", "<i8"), ("start", "<i8"), ("dst", "<i8"), ("own", "<i4"), ("w", "<f8")))
                z = (x / root)[np.searchsorted(at, dst)]
                total = np.column_stack([np.add.reduceat(w * np.ascontiguousarray(v)[own], start) for v in z.T])
                for block, some in _to_blocks(src, width):
                    to = src[some] - block * width
                    if block == here and part == 0:
                        kept[np.searchsorted(at, to)] += total[some]
                    else:
                        out.append({"block": block, "part": part, "origin": here, "at": _bytes(to, "<i8"), "deg": None, "v": _bytes(total[some], "<f8")})
            if part == 0:
                out.append({"block": here, "part": part, "origin": here, "at": _bytes(at, "<i8"), "deg": _bytes(deg, "<f8"), "v": _bytes(kept, "<f8")})
            return _table(out, message)

        def add(sent: pa.Table) -> pa.Table:
            order = np.lexsort((sent["part"].to_numpy(), sent["origin"].to_numpy())).tolist()
            own = next(i for i in order if sent["deg"][i].is_valid)
            at, deg, total = _of(sent, "at", "<i8", own), _of(sent, "deg", "<f8", own), _of(sent, "v", "<f8", own).reshape(-1, k).copy()
            for i in order:
                if i != own:
                    total[np.searchsorted(at, _of(sent, "at", "<i8", i))] += _of(sent, "v", "<f8", i).reshape(-1, k)
            return _held(sent["block"][0].as_py(), at, deg, total / (2 * np.sqrt(deg)[:, None]))

        return self._met(held.drop("gram")).applyInArrow(send, _SENT).groupBy("block").applyInArrow(add, _HELD)

    def unpacked(self, held: DataFrame, turn: np.ndarray, names: Sequence[str]) -> DataFrame:
        """``(id, deg, names ...)``: a row for each row of the graph, the block turned."""
        width, k = self.width, len(turn)

        def run(rows: pa.Table) -> pa.Table:
            x = _of(rows, "v", "<f8").reshape(-1, k) @ turn[:, :len(names)]
            return pa.table([pa.array(_of(rows, "at", "<i8") + rows["block"][0].as_py() * width), pa.array(_of(rows, "deg", "<f8")), *(pa.array(np.ascontiguousarray(v)) for v in x.T)],
                            names=["id", "deg", *names])

        return held.groupBy("block").applyInArrow(run, "id long, deg double" + "".join(f", {c} double" for c in names))


def _held(block: int, at: np.ndarray, deg: np.ndarray, v: np.ndarray) -> pa.Table:
    return pa.table({"block": pa.array([block], _LONG), "at": pa.array([_bytes(at, "<i8")], _BIN), "deg": pa.array([_bytes(deg, "<f8")], _BIN),
                     "v": pa.array([_bytes(v, "<f8")], _BIN), "gram": pa.array([_bytes(v.T @ v, "<f8")], _BIN)})


def eigenvectors(links: DataFrame, features: DataFrame, k: int, tol: float = TOL, max_rounds: int = MAX_ROUNDS) -> tuple[np.ndarray, DataFrame, int]:
    """Top ``k`` eigenvalues of ``D^-1/2 W D^-1/2``, the rows ``(id, deg, v0 ...)`` of its eigenvectors, and the rounds taken.

    ``links`` (src, dst, w) lead both ways; weights of one pair add up.
    ``features`` gives every row of the graph (id) its feature: numbers from 0, so few that their graph is solved on the driver.
    Any ids do; the less is shuffled, the more links join rows whose ids lie close together.
    """
    spark = links.sparkSession
    packed = _Packed(links, features)
    rows, w = packed.coarse()
    m = min(packed.size, k + EXTRA)
    total = np.maximum(w.sum(axis=1), 1e-300)
    _, vectors = np.linalg.eigh(w / np.sqrt(total[:, None] * total))
    names = [f"v{j}" for j in range(m)]

    def written(df: DataFrame) -> tuple[str, DataFrame]:
        path = scratch_path(spark, "block")
        df.write.parquet(path)
        return path, spark.read.schema(_HELD).parquet(path)

    path, held = written(packed.start(rows, vectors[:, ::-1][:, :m] / np.sqrt(total)[:, None]))
    values, taken = None, 0
    while True:
        grams = {r["block"]: np.frombuffer(r["gram"], dtype="<f8").reshape(m, m) for r in held.select("block", "gram").collect()}  # a row a block
        theta, q = np.linalg.eigh(sum((grams[b] for b in sorted(grams)), np.zeros((m, m))))
        theta, q = theta[::-1], q[:, ::-1]
        turn = q / np.sqrt(np.maximum(theta, 1e-300))
        new = np.sqrt(np.maximum(theta, 0))[:k]
        if taken:  # the block was orthonormal before the step: roots of the Gram's values are those of the operator
            done = values is not None and np.abs(new - values).max() <= tol
            values = new
        else:
            done = False
        if done or taken == max_rounds:
            return 2 * values - 1, packed.unpacked(held, turn, names[:k]), taken
        last = path
        path, held = written(packed.times(held, turn))
        drop_path(spark, last)
        taken += 1


def spectral(df: DataFrame, features: Sequence[str], k: int, keep: Sequence[str] = (), n_neighbors: int = NEIGHBORS, seed: int = 0, starts: int = KM.STARTS,
             entries: int = WD.ENTRIES, tol: float = TOL, name: str = "cluster") -> DataFrame:
    """``keep`` columns and the spectral cluster of every row without NULLs."""
    source = df.select(*keep, F.array(*[F.col(c).cast("double") for c in features]).alias("x")).where("NOT exists(x, v -> v IS NULL)")
    rows = checkpointed(global_index(source, ["x"], name="_id"))
    points = rows.select(F.col("_id").alias("id"), "x")
    if points.first() is None:
        return rows.select(*keep, F.lit(0).alias(name))
    path = scratch_path(df.sparkSession, "edges")
    neighbors(points, n_neighbors, seed=seed).select("src", "dst").write.parquet(path)
    links = both_ways(df.sparkSession.read.schema("src long, dst long").parquet(path))
    n, c, q = WD.features_of(points, entries)
    own = KM.assign(points, c, keep=["id"], name="feature").withColumn("feature", F.col("feature").cast("long"))
    _, basis, _ = eigenvectors(links, checkpointed(own), k, tol)
    drop_path(df.sparkSession, path)
    embedded = basis.select("id", *[(F.col(f"v{j}") / F.sqrt("deg")).alias(f"e{j}") for j in range(k)])
    columns = [f"e{j}" for j in range(k)]
    spots, best = KM.best_by_k(embedded, columns, ["id"], [k], starts, seed)
    found = KM.assign(spots, best[k].centers, keep=["id"], name=name).withColumnRenamed("id", "f_id")
    return rows.join(found, F.col("_id") == F.col("f_id")).select(*keep, name)
