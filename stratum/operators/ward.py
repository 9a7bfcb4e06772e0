"""Ward's hierarchy of all rows over clustering features (CLU5).

A clustering feature is a count, a centroid and the squares about it; two add
up exactly.  Every task turns its rows into at most ``entries`` features by
Ward's own criterion: as soon as twice as many are held, reciprocal nearest
neighbours are merged, the cheapest first.  The features of tasks are
merged the same way in lanes of eight tasks, lane after lane, until one set is left.  The tree
over these is plain Ward: merging reciprocal nearest neighbours in any order
gives the hierarchy of merging the closest pair each time.

A table of up to ``entries`` rows is never compressed, so its tree is Ward's of
the rows.  Beyond that, ``Tree.loss`` is the share of the rows' total squares
that lies inside features, which the tree cannot see.  Rows with a NULL feature
are left out; an empty table has an empty tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import small_frame
from ..session import checkpointed
from .lloyd import as_points, nearest, vectors

ENTRIES = 1024
FAN_IN = 8
#: numbers that a strip of features against all others holds at once
_STRIP = 1 << 16


def _cost(n: np.ndarray, c: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Growth of the squares by the union of features ``a`` and ``b`` (places, broadcast)."""
    d = 0.0
    for v in c.T:
        e = v[a] - v[b]
        d = d + e * e
    return d * (n[a] * n[b] / (n[a] + n[b]))


def _nearest_parts(n: np.ndarray, c: np.ndarray, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each feature (or those at ``asked``) the other one whose union with it makes the squares grow least (ties: the first), and the growth.

    A strip of the features meets all others at a time: what a pass holds stays in the processor's cache.  One product gives a
    lower bound of each cost, off by rounding only; where it leaves a feature more than one candidate, these are compared exactly.
    """
    asked = np.arange(len(n)) if asked is None else asked
    near = np.empty(len(asked), dtype=np.int64)
    x = c - c.mean(axis=0)
    own = (x * x).sum(axis=1)
    off = 16 * (c.shape[1] + 4) * np.finfo(float).eps * float(own.max(initial=0.0))  # no squared distance is off by more
    left = np.column_stack([-2 * x, own, np.ones(len(n))])
    right = np.ascontiguousarray(np.column_stack([x, np.ones(len(n)), own - off]).T)
    r = 1 / n
    strip = max(1, _STRIP // max(1, len(n)))
    d, e, few = np.empty((strip, len(n))), np.empty((strip, len(n))), np.empty((strip, len(n)), dtype=bool)
    for lo in range(0, len(asked), strip):
        rows = asked[lo:lo + strip]
        here, part, within, at = d[:len(rows)], e[:len(rows)], few[:len(rows)], np.arange(len(rows))
        np.matmul(left[rows], right, out=here)
        np.add(r[rows, None], r, out=part)
        here /= part
        here[at, rows] = np.inf
        best = here.argmin(axis=1)
        least = here[at, best]
        np.less_equal(here, (least + 2 * off / part[at, best] + 1e-14 * np.abs(least))[:, None], out=within)
        if np.count_nonzero(within) > len(rows):
            for i in np.flatnonzero(np.count_nonzero(within, axis=1) > 1):
                some = np.flatnonzero(within[i])
                best[i] = some[_cost(n, c, rows[i], some).argmin()]
        near[lo:lo + strip] = best
    return near, _cost(n, c, asked, near) if len(n) > 1 else np.full(len(asked), np.inf)


def _rounds(n: np.ndarray, c: np.ndarray, target: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rounds of merges down to ``target`` features: places of both parts among the held ones, costs, counts.

    A union is never nearer to a feature than the nearer of its parts was, so only unions and features whose nearest
    was merged look for their nearest again.
    """
    near, cost = _nearest_parts(n, c) if len(n) > target else (np.zeros(len(n), dtype=np.int64), np.zeros(len(n)))
    while len(n) > target:
        a = np.flatnonzero((near[near] == np.arange(len(n))) & (np.arange(len(n)) < near))
        a = a[np.argsort(cost[a], kind="stable")][:len(n) - target]
        b = near[a]
        yield a, b, cost[a], n[a] + n[b]
        whole = n[a] + n[b]
        c = c.copy()
        c[a] += (c[b] - c[a]) * (n[b] / whole)[:, None]
        n = n.copy()
        n[a] = whole
        keep = np.ones(len(n), dtype=bool)
        keep[b] = False
        merged = ~keep
        merged[a] = True
        again = np.flatnonzero((merged | merged[near])[keep])
        near, cost = (np.cumsum(keep) - 1)[near][keep], cost[keep]
        n, c = n[keep], c[keep]
        if len(n) > target:
            near[again], cost[again] = _nearest_parts(n, c, again)


def _distinct(n: np.ndarray, c: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features at one place as one, at the place of the first: these unions cost nothing."""
    order = np.lexsort(c.T)
    new = np.ones(len(n), dtype=bool)
    new[1:] = (c[order][1:] != c[order][:-1]).any(axis=1)
    if new.all():
        return n, c, q
    start = np.flatnonzero(new)
    first = np.minimum.reduceat(order, start)
    back = np.argsort(first)
    return np.add.reduceat(n[order], start)[back], c[first[back]], np.add.reduceat(q[order], start)[back]


def compressed(n: np.ndarray, c: np.ndarray, q: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``entries`` features with the same counts, sums and squares."""
    if len(n) > entries:  # else every round would merge one pair of a group of equal ones
        n, c, q = _distinct(n, c, q)
    for a, b, cost, whole in _rounds(n, c, entries):
        c, q, n = c.copy(), q.copy(), n.copy()
        c[a] += (c[b] - c[a]) * (n[b] / whole)[:, None]
        q[a] += q[b] + cost
        n[a] = whole
        keep = np.ones(len(n), dtype=bool)
        keep[b] = False
        n, c, q = n[keep], c[keep], q[keep]
    return n, c, q


@dataclass
class Tree:
    """Features (``n``, ``c``, squares ``q``) and merges in order of height: two parts (features, then merges by number), height, rows."""

    n: np.ndarray
    c: np.ndarray
    q: np.ndarray
    merges: list[tuple[int, int, float, int]]

    @property
    def loss(self) -> float:
        """Share of the total squares that lies inside features."""
        inside = float(self.q.sum())
        total = inside + sum(h * h / 2 for *_, h, _ in self.merges)
        return inside / total if total else 0.0

    def merge_table(self, spark) -> DataFrame:
        return small_frame(spark, [(i, *m) for i, m in enumerate(self.merges)], "merge int, part_a int, part_b int, height double, n_rows long")

    def cut(self, k: int) -> np.ndarray:
        """Cluster of every feature at ``k`` clusters; the largest cluster is 0 (ties: by centroid)."""
        parent = list(range(len(self.n) + len(self.merges)))
        for i, (a, b, *_) in enumerate(self.merges[:max(0, len(self.n) - k)]):
            parent[a] = parent[b] = len(self.n) + i

        def root(i: int) -> int:
            while parent[i] != i:
                i = parent[i]
            return i

        roots = np.array([root(i) for i in range(len(self.n))], dtype=np.int64)
        known, own = np.unique(roots, return_inverse=True)
        size = np.bincount(own, self.n, minlength=len(known))
        mean = np.stack([np.bincount(own, self.n * v, minlength=len(known)) / size for v in self.c.T]) if len(known) else np.zeros((1, 0))
        rank = np.empty(len(known), dtype=np.int64)
        rank[np.lexsort((*mean[::-1], -size))] = np.arange(len(known))
        return rank[own]

    def assign(self, points: DataFrame, k: int, keep: Sequence[str] = (), name: str = "cluster") -> DataFrame:
        """``keep`` columns and the cluster of the nearest feature for every row of ``points``."""
        sent = points.sparkSession.sparkContext.broadcast((self.c, self.cut(k)))
        source = points.select(*keep, "x")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centers, cluster = sent.value
            for batch in batches:
                if batch.num_rows:
                    own = cluster[nearest(vectors(batch.column(len(keep))), centers)[0]]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own.astype(np.int32))], names=[*keep, name])

        return source.mapInArrow(run, source.select(*keep, F.lit(0).alias(name)).schema)


def tree_of(n: np.ndarray, c: np.ndarray, q: np.ndarray) -> Tree:
    """Ward's tree over features; a merge's height is the root of twice the growth of the squares."""
    names = np.arange(len(n))
    found = []  # (cost, part, part, rows, own name)
    fresh = len(n)
    for a, b, cost, whole in _rounds(n, c, 1):
        made = np.arange(fresh, fresh + len(a))
        found += list(zip(cost.tolist(), names[a].tolist(), names[b].tolist(), whole.tolist(), made.tolist()))
        fresh += len(a)
        names = names.copy()
        names[a] = made
        keep = np.ones(len(names), dtype=bool)
        keep[b] = False
        names = names[keep]
    # a merge never costs less than one below it, so this order keeps parts before wholes
    order = sorted(range(len(found)), key=lambda i: (found[i][0], found[i][4]))
    place = {found[i][4]: len(n) + k for k, i in enumerate(order)}
    merges = [(*sorted((place.get(found[i][1], found[i][1]), place.get(found[i][2], found[i][2]))), float(np.sqrt(2 * max(found[i][0], 0.0))), int(found[i][3])) for i in order]
    return Tree(n, c, q, merges)


def _table(n: np.ndarray, c: np.ndarray, q: np.ndarray, part: int) -> dict[str, pa.Array]:
    return {"part": pa.array(np.full(len(n), part)), "n": pa.array(n), "c": pa.array(c.tolist(), pa.list_(pa.float64())), "q": pa.array(q)}


_SCHEMA = "part long, n double, c array<double>, q double"


def features_of(points: DataFrame, entries: int = ENTRIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``entries`` clustering features of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = None
        for batch in batches:
            for lo in range(0, batch.num_rows, entries):
                x = vectors(batch.column(0).slice(lo, entries))
                new = np.ones(len(x)), x, np.zeros(len(x))
                held = new if held is None else tuple(np.concatenate(p) for p in zip(held, new))
                if len(held[0]) >= 2 * entries:
                    held = compressed(*held, entries)
        if held is not None:
            yield pa.RecordBatch.from_pydict(_table(*compressed(*held, entries), TaskContext.get().partitionId()))

    def merge(rows: pa.Table) -> pa.Table:
        held = None
        for lo in range(0, rows.num_rows, entries):
            part = rows.slice(lo, entries)
            new = part["n"].to_numpy(), vectors(part["c"].combine_chunks()), part["q"].to_numpy()
            held = new if held is None else compressed(*(np.concatenate(p) for p in zip(held, new)), entries)
        return pa.table(_table(*held, rows["part"][0].as_py()))

    found = checkpointed(points.select("x").mapInArrow(run, _SCHEMA))
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        found = checkpointed(found.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInArrow(merge, _SCHEMA))
        parts = -(-parts // FAN_IN)
    rows = found.toArrow()  # ``entries`` rows at most
    c = np.array(rows["c"].to_pylist(), dtype=float) if rows.num_rows else np.zeros((0, 0))
    order = np.lexsort((*c.T[::-1], rows["n"].to_numpy()))
    return rows["n"].to_numpy()[order], c[order], rows["q"].to_numpy()[order]


def ward(df: DataFrame, features: Sequence[str] | str, keep: Sequence[str] = (), entries: int = ENTRIES) -> tuple[DataFrame, Tree]:
    """The written points and Ward's tree over their features."""
    points = checkpointed(as_points(df, features, keep))
    return points, tree_of(*features_of(points, entries))
