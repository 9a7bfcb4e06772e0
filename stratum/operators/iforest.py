"""Isolation forest (OUT3), built and scored on Spark.

* sampling: one md5 per row draws a bounded uniform pool (about
  oversample x trees x psi rows, independent of n); inside the pool every
  (tree, row) pair gets ``u = md5(seed:tree | key)`` and a tree keeps its psi
  smallest, so each tree's window partition holds a few hundred rows;
* building: ``groupBy(tree).applyInPandas`` grows all trees in parallel
  (each group holds <= psi rows); split feature and value come from a numpy
  generator seeded by md5(seed, tree), so the forest is reproducible;
* scoring: the forest (trees x <= 2 psi nodes, independent of n) is
  broadcast as node-indexed arrays and ``mapInPandas`` walks each tree level
  by level for a whole Arrow batch at once (depth <= log2 psi numpy steps).

Score ``s = 2^(-E[h] / c(psi))`` with ``c(n) = 2 H(n-1) - 2 (n-1)/n``.
``contamination="auto"`` flags s > 0.5; a share flags the top share by the
approximate (1 - share) quantile of the scores.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashrand import uniform
from .quantiles import quantiles

EULER = 0.5772156649015329


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _tree_seed(seed: int, tree: int) -> int:
    return int(hashlib.md5(f"{seed}|tree|{tree}".encode()).hexdigest()[:12], 16)


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes as (node, feature, split, left, right, size, depth); leaves have feature -1."""
    nodes: list[tuple] = []
    stack = [(np.arange(len(x)), 0, 0)]
    next_id = 1
    while stack:
        idx, node, depth = stack.pop()
        if depth >= max_depth or len(idx) <= 1:
            nodes.append((node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        splittable = np.nonzero(hi > lo)[0]
        if splittable.size == 0:
            nodes.append((node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        f = int(splittable[rng.integers(splittable.size)])
        split = float(rng.uniform(lo[f], hi[f]))
        left, right = next_id, next_id + 1
        next_id += 2
        nodes.append((node, f, split, left, right, len(idx), depth))
        mask = sub[:, f] < split
        stack.append((idx[mask], left, depth + 1))
        stack.append((idx[~mask], right, depth + 1))
    return nodes


@dataclass(frozen=True)
class IsolationForest:
    features: tuple[str, ...]
    psi: int
    trees: dict[int, dict[int, tuple]]  # tree -> node -> (feature, split, left, right, size, depth)

    def arrays(self) -> list[tuple[np.ndarray, ...]]:
        """Per tree: feature, split, left, right, leaf path length (depth + c(size)) as node-indexed arrays."""
        out = []
        for nodes in self.trees.values():
            m = max(nodes) + 1
            feat = np.full(m, -1, dtype=np.int64)
            split = np.zeros(m)
            left = np.zeros(m, dtype=np.int64)
            right = np.zeros(m, dtype=np.int64)
            leaf = np.zeros(m)
            for nid, (f, sp, lft, rgt, size, d) in nodes.items():
                feat[nid], split[nid] = f, sp
                left[nid], right[nid] = max(lft, 0), max(rgt, 0)
                leaf[nid] = d + c_factor(size)
            out.append((feat, split, left, right, leaf))
        return out

    def path_lengths(self, x: np.ndarray, arrays: list[tuple[np.ndarray, ...]] | None = None) -> np.ndarray:
        """Mean path length over trees; every tree is walked level by level for all rows at once."""
        arrays = arrays if arrays is not None else self.arrays()
        rows = np.arange(len(x))
        total = np.zeros(len(x))
        for feat, split, left, right, leaf in arrays:
            cur = np.zeros(len(x), dtype=np.int64)
            while True:
                f = feat[cur]
                inner = f >= 0
                if not inner.any():
                    break
                go_left = x[rows, np.where(inner, f, 0)] < split[cur]
                cur = np.where(inner, np.where(go_left, left[cur], right[cur]), cur)
            total += leaf[cur]
        return total / max(len(arrays), 1)

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Anomaly score per row (rows with a NULL feature are skipped)."""
        spark = df.sparkSession
        bc = spark.sparkContext.broadcast(self)  # forest size: trees x <= 2 psi nodes
        cols = list(self.features)
        cpsi = c_factor(self.psi)
        src = df.dropna(subset=cols).select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
        schema = T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType())])

        def run(batches):
            forest = bc.value
            arrays = forest.arrays()  # once per task
            for b in batches:
                if b.empty:
                    continue
                h = forest.path_lengths(b[cols].to_numpy(dtype=float), arrays)
                yield b.assign(score=np.power(2.0, -h / cpsi))

        return src.mapInPandas(run, schema)


def fit(df: DataFrame, features: Sequence[str], key: Sequence[str], n_trees: int = 100, psi: int = 256,
        seed: int = 0, oversample: float = 3.0) -> IsolationForest:
    """Build the forest; ``key`` identifies rows for the hash sampling.

    Two-level sampling keeps the cost at one hash per row: a uniform pool of
    about ``oversample * n_trees * psi`` rows is drawn first (independent of
    n), then every tree takes the psi rows with the smallest ``md5(seed:tree|key)``
    inside the pool.  Two trees share psi^2 / pool rows on average (< 1 row
    for the defaults), so samples are practically independent.
    """
    cols = list(features)
    base = df.dropna(subset=cols)
    n = base.count()
    psi = int(min(psi, n))
    if psi < 2:
        raise ValueError("need at least two complete rows")
    pool_share = min(1.0, oversample * n_trees * psi / n)
    pool = base.filter(uniform(f"{seed}:pool", *key) < pool_share).select(
        *key, *[F.col(c).cast("double").alias(c) for c in cols])
    thr = min(1.0, oversample * psi / max(pool_share * n, 1.0))
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree")
    cand = (pool.select("*", trees)
            .withColumn("_u", uniform(F.concat(F.lit(f"{seed}:"), F.col("tree").cast("string")), *key))
            .filter(F.col("_u") < thr))
    sample = cand.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_u", *key))).filter(
        F.col("_r") <= psi)  # per tree: about oversample * psi candidate rows
    max_depth = int(math.ceil(math.log2(psi)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(_tree_seed(seed, t))
        nodes = _grow(pdf[cols].to_numpy(dtype=float), rng, max_depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "depth"])
        out.insert(0, "tree", t)
        return out

    schema = "tree int, node int, feature int, split double, left int, right int, size int, depth int"
    rows = sample.select("tree", *cols).groupBy("tree").applyInPandas(build, schema).collect()
    forest: dict[int, dict[int, tuple]] = {}
    for r in rows:  # trees x <= 2 psi nodes
        forest.setdefault(r["tree"], {})[r["node"]] = (r["feature"], r["split"], r["left"], r["right"], r["size"],
                                                       r["depth"])
    return IsolationForest(tuple(cols), psi, forest)


def flag(scored: DataFrame, contamination: float | str = "auto") -> DataFrame:
    """Boolean anomaly flag per row from scores."""
    if contamination == "auto":
        return scored.withColumn("anomaly", F.col("score") > 0.5)
    share = float(contamination)
    if not 0.0 < share < 0.5:
        raise ValueError("contamination must be 'auto' or in (0, 0.5)")
    # the cut needs one pass over the scores and the flags another: keep the scores
    # (spillable) so the forest walk in Python runs once per row
    kept = scored.persist(StorageLevel.MEMORY_AND_DISK)
    cut = quantiles(kept, ["score"], [1.0 - share])["score"][0]
    return kept.withColumn("anomaly", F.col("score") >= F.lit(cut))
