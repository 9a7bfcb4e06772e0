"""Regression forest (OLS10): all trees grow together, a level a scan.

The rows are written once as packed blocks: a byte a feature (its bin), the
target and a hash of the row's key.  A scan of a level leads every row down
every tree so far and sums weight and target by node, feature and bin; the sums
of all tasks meet by tree, where each node's best split is chosen.  What is
sent around is one block of sums a tree and task, whatever the number of rows.

How often a row is drawn for a tree (Poisson, mean 1) follows from its hash and
the tree's number and is found again in each scan: nothing is kept for each
pair of row and tree, and the forest does not depend on how rows are dealt.

As in Spark's library: thresholds between the values of 10,000 rows, in up to
32 bins; a third of the features asked at each node; variance as impurity.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashrand import POISSON1_CDF
from ..session import checkpointed, drop_path, scratch_path

MAX_BINS = 32
#: rows whose values give the thresholds, as in Spark's library
_CANDIDATES = 10_000
#: bytes of sums that a task holds at most; more trees are taken in several scans
_SUMS = 1 << 25
#: rows a task reads at most, about
_TASK = 1 << 21
#: a cut above every bin: all rows go left, the node is a leaf
_LEAF = 255
_POISSON1_STEPS = [np.uint32(min(int(np.ceil(p * 2**32)), 2**32 - 1)) for p in POISSON1_CDF]


@dataclass
class Forest:
    """Nodes of each tree by level (children of place i: 2i and 2i+1 of the next), values below the last level."""

    thresholds: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    importances: np.ndarray

    @property
    def depth(self) -> int:
        return (self.value.shape[1] - 1).bit_length()


def thresholds(values: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Cuts between the sorted values: between all that differ, if these are few, else so that bins have near equal counts."""
    v, n = np.unique(values, return_counts=True)
    middles = (v[:-1] + v[1:]) / 2
    if len(middles) < bins:
        return middles
    stride = len(values) / bins
    seen, target, cuts = 0, stride, []
    for i, (count, after) in enumerate(zip(n[:-1], n[1:])):
        seen += count
        if abs(seen - target) < abs(seen + after - target):
            cuts.append(middles[i])
            target += stride
    return np.array(cuts)


def draws(h: np.ndarray, pair: int) -> np.ndarray:
    """How often rows of these hashes are drawn for the trees ``2 * pair`` and ``2 * pair + 1`` (two lines)."""
    x = h + np.uint64((pair + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    u = np.ascontiguousarray(x.astype("<u8", copy=False).view("<u4").reshape(-1, 2).T)
    count = np.zeros(u.shape, dtype=np.uint8)
    for p in _POISSON1_STEPS:
        count += u >= p
    return count


def asked(seed: int, tree: int, depth: int, d: int, k: int) -> np.ndarray:
    """The ``k`` of ``d`` features that each node of a tree may split by (nodes of all levels, one below the other)."""
    return np.sort(np.random.default_rng([seed, tree]).random((2**depth - 1, d)).argsort(axis=1)[:, :k], axis=1)


def _place(bins: np.ndarray, base: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Place of each row among the nodes of level ``depth``; ``base`` is where a row's bins begin."""
    place = np.zeros(len(base), dtype=np.int64)
    for level in range(depth):
        own = slice(2**level - 1, 2 ** (level + 1) - 1)
        at = feature[own].take(place)
        at += base
        right = bins.take(at) > cut[own].take(place)
        place <<= 1
        place += right
    return place


def _packed(rows: DataFrame, features: Sequence[str], cuts: list[np.ndarray], parts: int) -> DataFrame:
    """Blocks of rows: bins (row after row), target and hash, learned and held-out rows apart."""
    d = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda i: batch.column(i).to_numpy(zero_copy_only=False)
            bins = np.column_stack([np.searchsorted(c, column(i), side="left") for i, c in enumerate(cuts)]).astype(np.uint8)
            y, h, held = column(d), column(d + 1), column(d + 2).astype(bool)
            for side in (False, True):
                own = held == side
                if own.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([side]), *(pa.array([np.ascontiguousarray(v[own]).tobytes()], pa.binary()) for v in (bins, y, h))],
                        names=["held", "bins", "y", "h"])

    blocks = rows.select(*features, "y", "h", "held").mapInArrow(run, "held boolean, bins binary, y binary, h binary")
    return checkpointed(blocks.repartition(parts))


def _opened(batch: pa.RecordBatch, d: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for bins, y, h in zip(*(batch.column(c) for c in ("bins", "y", "h"))):
        yield (np.frombuffer(bins.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), "<f8"), np.frombuffer(h.as_buffer(), "<u8"))


def _best(sums: np.ndarray, features: np.ndarray) -> list[np.ndarray]:
    """Best split of each node (ties: the first) from ``sums`` (weight and target by node, asked feature and bin)."""
    left = np.cumsum(sums, axis=-1)[..., :-1]
    whole = sums.sum(axis=-1, keepdims=True)
    (wl, yl), (wr, yr) = left, whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((wl > 0) & (wr > 0), wl * wr / whole[0] * (yl / wl - yr / wr) ** 2, 0.0)
        best = gain.reshape(len(gain), -1).argmax(axis=1)
        node = np.arange(len(gain))
        slot, cut = best // gain.shape[-1], best % gain.shape[-1]
        gain, (weight, target) = gain[node, slot, cut], whole[:, :, 0, 0]
        mean, split = np.where(weight > 0, target / weight, 0.0), gain > 0
        means = [np.where(split, m, mean) for m in (yl[node, slot, cut] / wl[node, slot, cut], yr[node, slot, cut] / wr[node, slot, cut])]
    return [features[node, slot], np.where(split, cut, _LEAF), gain, *means]


def _level(blocks: DataFrame, forest: Forest, level: int, trees: range, subsets: np.ndarray, middle: float, scale: float) -> pd.DataFrame:
    """Best splits of a level's nodes of some trees, from one scan of the rows."""
    d, bins, nodes, k = len(forest.thresholds), MAX_BINS, 2**level, subsets.shape[2]
    sent = blocks.sparkSession.sparkContext.broadcast((forest.feature, forest.cut, subsets[:, nodes - 1:2 * nodes - 1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, cut, may = sent.value
        total = np.zeros((len(trees), 2, k, nodes * bins))
        for batch in batches:
            for x, y, h in _opened(batch, d):
                y = np.rint((y - middle) * scale)  # whole numbers: sums are exact in any order
                for t, sums in zip(trees, total):
                    if t % 2 == 0 or t == trees.start:
                        drawn = draws(h, t // 2)
                    n = drawn[t % 2]
                    rows = np.flatnonzero(n != 0)
                    n = n.take(rows).astype(float)
                    own = y.take(rows)
                    own *= n
                    rows *= d
                    place = _place(x, rows, feature[t], cut[t], level)
                    cell = place * bins
                    for s in range(k):
                        at = may[t, :, s].take(place)
                        at += rows
                        at = cell + x.take(at)
                        sums[0, s] += np.bincount(at, n, nodes * bins)
                        sums[1, s] += np.bincount(at, own, nodes * bins)
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int32()), pa.array([s.tobytes() for s in total], pa.binary())], names=["tree", "sums"])

    def best(parts: pd.DataFrame) -> pd.DataFrame:
        tree = int(parts["tree"].iloc[0])
        total = np.zeros(2 * k * nodes * bins)
        for s in parts["sums"]:
            total += np.frombuffer(s)
        sums = total.reshape(2, k, nodes, bins).transpose(0, 2, 1, 3)
        names = ["feature", "cut", "gain", "left", "right"]
        return pd.DataFrame({"tree": tree, "node": np.arange(nodes)} | dict(zip(names, _best(sums, sent.value[2][tree]))))

    found = blocks.select("bins", "y", "h").mapInArrow(run, "tree int, sums binary").groupBy("tree").applyInPandas(
        best, "tree int, node int, feature long, cut long, gain double, left double, right double")
    splits = found.toPandas()  # a row a node
    sent.unpersist()
    return splits.sort_values(["tree", "node"])


def _grow(blocks: DataFrame, cuts: list[np.ndarray], n: int, low: float, high: float, n_trees: int, depth: int, seed: int) -> Forest:
    d = len(cuts)
    k = d if n_trees == 1 else -(-d // 3)
    subsets = np.stack([asked(seed, t, depth, d, k) for t in range(n_trees)])
    inner = (n_trees, 2**depth - 1)
    forest = Forest(cuts, np.zeros(inner, np.int64), np.full(inner, _LEAF, np.uint8), np.zeros((n_trees, 1)), np.zeros(d))
    middle = low / 2 + high / 2
    # a power of two: the sums of 2n + 100 drawn targets stay below 2^53
    scale = 2.0 ** np.floor(52 - np.log2(2 * n + 100) - np.log2((high - low) or 1.0))
    gains = np.zeros((n_trees, d))
    is_open = np.ones((n_trees, 1), bool)
    for level in range(depth):
        nodes = 2**level
        lot = max(2, _SUMS // (nodes * k * MAX_BINS * 16) // 2 * 2)
        found = pd.concat([_level(blocks, forest, level, range(a, min(a + lot, n_trees)), subsets, middle, scale) for a in range(0, n_trees, lot)])
        feature, cut, gain, left, right = (found[c].to_numpy().reshape(n_trees, nodes) for c in ("feature", "cut", "gain", "left", "right"))
        # below a leaf nothing is split
        split = is_open & (cut != _LEAF)
        own = slice(nodes - 1, 2 * nodes - 1)
        forest.feature[:, own] = np.where(split, feature, 0)
        forest.cut[:, own] = np.where(split, cut, _LEAF)
        before = np.where(is_open, left, forest.value) if level == 0 else forest.value
        forest.value = np.stack([np.where(split, left, before), np.where(split, right, before)], axis=2).reshape(n_trees, 2 * nodes)
        is_open = np.repeat(split, 2, axis=1)
        tree, node = np.nonzero(split)
        np.add.at(gains, (tree, feature[tree, node]), gain[tree, node])
    forest.value = forest.value / scale + middle
    shares = gains.sum(axis=1, keepdims=True)
    total = np.divide(gains, shares, out=np.zeros_like(gains), where=shares > 0).sum(axis=0)
    forest.importances = total / total.sum() if total.any() else total
    return forest


def _predicted(blocks: DataFrame, forest: Forest) -> DataFrame:
    """``(y, prediction)`` of every row of the blocks."""
    d = len(forest.thresholds)
    sent = blocks.sparkSession.sparkContext.broadcast((forest.feature, forest.cut, forest.value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, cut, value = sent.value
        depth = (value.shape[1] - 1).bit_length()
        for batch in batches:
            for x, y, _ in _opened(batch, d):
                base, total = np.arange(len(y)) * d, np.zeros(len(y))
                for f, c, v in zip(feature, cut, value):
                    total += v.take(_place(x, base, f, c, depth))
                yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(total / len(value))], names=["y", "prediction"])

    return blocks.select("bins", "y", "h").mapInArrow(run, "y double, prediction double")


def fit(df: DataFrame, target: str, features: Sequence[str], key: Sequence[str], held: str, n_trees: int, max_depth: int,
        seed: int) -> tuple[Forest, DataFrame]:
    """The forest of the rows where ``held`` is false, and ``(y, prediction)`` of the others."""
    spark = df.sparkSession
    names = [f"x{i}" for i in range(len(features))]
    rows = df.select(*(F.col(c).cast("double").alias(n) for c, n in zip(features, names)), F.col(target).cast("double").alias("y"),
                     F.xxhash64(F.lit(seed), *key).alias("h"), F.col(held).alias("held"))
    path = scratch_path(spark, "forest")
    try:
        rows.write.parquet(path)  # the source is read and derived once
        rows = spark.read.schema(rows.schema).parquet(path)
        learned = rows.where(~F.col("held"))
        n, low, high = learned.agg(F.count(F.lit(1)), F.min("y"), F.max("y")).first()
        if n == 0:
            raise ValueError("no rows to learn from")
        seen = learned.orderBy("h", "y", *names).limit(_CANDIDATES).select(*names).toPandas().to_numpy(dtype=float)
        cuts = [thresholds(v, min(MAX_BINS, n)) for v in seen.T]
        blocks = _packed(rows, names, cuts, max(2 * spark.sparkContext.defaultParallelism, n // _TASK))
    finally:
        drop_path(spark, path)
    forest = _grow(blocks.where(~F.col("held")), cuts, n, low, high, n_trees, max_depth, seed)
    return forest, _predicted(blocks.where("held"), forest)
