"""Clustering and cluster quality (CLU1-CLU6, CLU8, CLU9).

* k-means: ``pyspark.ml`` (k-means||) with restarts over seeds, or a plain
  Lloyd loop with fixed start centroids written as DataFrame aggregates
  (one ``groupBy(cluster)`` per iteration, centroids k x d on the driver).
* silhouette: squared-Euclidean closed form from per-cluster sufficient
  statistics (count, sum vector, sum of squared norms) - O(n k), no pairs.
* hierarchical: bisecting k-means, a tree grown from the top over all rows.
* spectral: power iteration on a sparse neighbour graph found along random
  directions; edges are linear in the rows.
* Rand index: contingency counts ``groupBy(a, b).count()`` + marginals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..frames import small_frame
from ..session import ensure_checkpoint_dir


def _vector_col(df: DataFrame, features: Sequence[str] | str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.feature import VectorAssembler

    if isinstance(features, str):  # an array<float|double> column
        return df.withColumn("features", array_to_vector(F.col(features).cast("array<double>")))
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(df)


@dataclass
class KMeansResult:
    k: int
    centers: np.ndarray
    inertia: float
    seed: int
    model: object

    def assign(self, df: DataFrame, features: Sequence[str] | str, keep: Sequence[str] = ()) -> DataFrame:
        out = self.model.transform(_vector_col(df, features))
        return out.select(*keep, F.col("prediction").alias("cluster"))


def kmeans(df: DataFrame, features: Sequence[str] | str, k: int, n_init: int = 3, seed: int = 0,
           max_iter: int = 50) -> KMeansResult:
    """CLU1: MLlib k-means, ``n_init`` restarts, the lowest within-cluster SS wins."""
    from pyspark.ml.clustering import KMeans

    vec = _vector_col(df, features).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    best = None
    try:
        for s in range(seed, seed + n_init):
            model = KMeans(k=k, seed=s, maxIter=max_iter, featuresCol="features").fit(vec)
            cost = float(model.summary.trainingCost)
            if best is None or cost < best.inertia:
                best = KMeansResult(k, np.array(model.clusterCenters()), cost, s, model)
    finally:
        vec.unpersist()
    return best


def elbow(df: DataFrame, features: Sequence[str] | str, ks: Sequence[int], n_init: int = 5, seed: int = 0) -> DataFrame:
    """CLU2: inertia by k, the best of ``n_init`` starts each."""
    rows = [(int(k), kmeans(df, features, k, n_init, seed).inertia) for k in ks]
    return small_frame(df.sparkSession, rows, "k int, inertia double")


def _sq_dist(cols: Sequence[Column], center: np.ndarray) -> Column:
    expr = None
    for c, m in zip(cols, center):
        d = c - F.lit(float(m))
        expr = d * d if expr is None else expr + d * d
    return expr


def _argmin(dists: Sequence[Column]) -> Column:
    best = F.least(*dists) if len(dists) > 1 else dists[0]
    out = F.lit(len(dists) - 1)
    for j in range(len(dists) - 2, -1, -1):
        out = F.when(dists[j] == best, F.lit(j)).otherwise(out)
    return out


def lloyd(df: DataFrame, features: Sequence[str], init: np.ndarray, iterations: int) -> tuple[np.ndarray, DataFrame]:
    """Plain Lloyd iterations from given start centroids (DataFrame aggregates only).

    Each step: assign by nearest centroid (ties -> lowest index), recompute
    centroids with ``groupBy(cluster).avg`` (k rows).  An emptied cluster
    keeps its previous centroid.
    """
    cols = [F.col(c).cast("double") for c in features]
    centers = np.array(init, dtype=float)
    # iterations re-read only the feature columns: keep them (spillable, recomputable)
    pts = df.select(*[c.alias(n) for c, n in zip(cols, features)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(iterations):
            lab = _argmin([_sq_dist([F.col(n) for n in features], c) for c in centers])
            agg = pts.select(lab.alias("cluster"), *features).groupBy("cluster").agg(
                *[F.avg(n).alias(n) for n in features]).collect()  # k rows
            new = centers.copy()
            for r in agg:
                new[r["cluster"]] = [r[n] for n in features]
            centers = new
    finally:
        pts.unpersist()
    lab = _argmin([_sq_dist(cols, c) for c in centers])
    return centers, df.withColumn("cluster", lab)


def cluster_stats(df: DataFrame, features: Sequence[str] | str, cluster: str) -> dict[int, tuple[float, np.ndarray, float]]:
    """Per cluster: count, sum vector, sum of squared norms (one aggregate, k rows)."""
    if isinstance(features, str):
        df = df.where(F.col(features).isNotNull())
        size = df.agg(F.min(F.size(features)).alias("lo"), F.max(F.size(features)).alias("hi")).first()
        if size["lo"] != size["hi"]:
            raise ValueError(f"vectors of {features!r} differ in length")
        d = size["lo"] or 0
        cols = [F.col(features)[i].cast("double") for i in range(d)]
    else:
        cols = [F.col(c).cast("double") for c in features]
    norm2 = None
    for c in cols:
        norm2 = c * c if norm2 is None else norm2 + c * c
    rows = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"), F.sum(norm2).alias("_q"),
                                   *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(cols)]).collect()
    return {r[cluster]: (float(r["_n"]), np.array([r[f"_s{i}"] for i in range(len(cols))], float), float(r["_q"]))
            for r in rows}


def silhouette_sq(df: DataFrame, features: Sequence[str] | str, cluster: str, keep: Sequence[str] = ()) -> DataFrame:
    """CLU4: per-row silhouette with *squared* Euclidean distances, exact, O(n k); rows without a vector are left out.

    ``sum_j |x_i - x_j|^2 = n_C |x_i|^2 - 2 x_i . S_C + Q_C`` per cluster C;
    singletons get 0 (the usual convention).  The k x d cluster statistics
    are broadcast; each Arrow batch is scored with one numpy matrix product
    (the per-row work is a d x k dot product, no pairs).
    """
    stats = cluster_stats(df, features, cluster)
    labels = sorted(stats)
    n = np.array([stats[c][0] for c in labels])
    s = np.vstack([stats[c][1] for c in labels])
    q = np.array([stats[c][2] for c in labels])
    bc = df.sparkSession.sparkContext.broadcast((n, s, q, np.array(labels)))  # k x d numbers
    if isinstance(features, str):
        df = df.where(F.col(features).isNotNull())
        src = df.select(*keep, F.col(cluster), F.col(features).cast("array<double>").alias("_x"))
    else:
        src = df.select(*keep, F.col(cluster), F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
    out_schema = T.StructType([*[src.schema[c] for c in [*keep, cluster]],
                               T.StructField("silhouette_sq", T.DoubleType())])

    def run(batches):
        n_, s_, q_, labs = bc.value
        for b in batches:
            if b.empty:
                continue
            x = np.vstack(b["_x"].to_numpy())
            own = np.searchsorted(labs, b[cluster].to_numpy())  # labels are sorted: vectorised lookup
            tot = n_[None, :] * (x * x).sum(1)[:, None] - 2.0 * x @ s_.T + q_[None, :]
            rows = np.arange(len(x))
            a = tot[rows, own] / np.maximum(n_[own] - 1.0, 1.0)
            mean_other = tot / n_[None, :]
            mean_other[rows, own] = np.inf
            bb = mean_other.min(axis=1)
            sil = np.where(n_[own] <= 1, 0.0, (bb - a) / np.maximum(a, bb))
            yield b.drop(columns=["_x"]).assign(silhouette_sq=sil)

    return src.mapInPandas(run, out_schema)


def mean_silhouette_by_k(df: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 0) -> DataFrame:
    """CLU3: average squared-Euclidean silhouette for each k (MLlib k-means labels)."""
    rows = []
    for k in ks:
        res = kmeans(df, features, k, n_init=1, seed=seed)
        lab = res.model.transform(_vector_col(df, features)).withColumnRenamed("prediction", "cluster")
        sil = silhouette_sq(lab, features, "cluster").agg(F.avg("silhouette_sq")).first()[0]
        rows.append((int(k), float(sil)))
    return small_frame(df.sparkSession, rows, "k int, silhouette_sq double")


def gaussian_mixture(df: DataFrame, features: Sequence[str] | str, k: int, seed: int = 0,
                     keep: Sequence[str] = ()) -> DataFrame:
    """CLU6: MLlib Gaussian mixture labels."""
    from pyspark.ml.clustering import GaussianMixture

    vec = _vector_col(df, features)
    model = GaussianMixture(k=k, seed=seed, featuresCol="features").fit(vec)
    return model.transform(vec).select(*keep, F.col("prediction").alias("cluster"))


def hierarchical(df: DataFrame, features: Sequence[str], k: int, min_share: float = 1.0, seed: int = 0,
                 max_iter: int = 50, keep: Sequence[str] = ()) -> DataFrame:
    """CLU5: hierarchical clusters of all rows by repeated bisection (MLlib bisecting k-means).

    The tree is grown from the top, each split a distributed two-means over the
    rows of its branch; an agglomerative tree of the rows would need all pairs.
    """
    from pyspark.ml.clustering import BisectingKMeans

    # a split starts at a small multiple of the branch's centre: features are moved off zero, which changes no distance
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    moved = {f"_f{i}": F.col(c).cast("double") - F.lit((row[f"m{i}"] or 0.0) - (row[f"s{i}"] or 1.0)) for i, c in enumerate(features)}
    vec = _vector_col(df.withColumns(moved), list(moved))
    held = vec.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = BisectingKMeans(k=k, seed=seed, maxIter=max_iter, minDivisibleClusterSize=min_share, featuresCol="features").fit(held)
    finally:
        held.unpersist()
    return model.transform(vec).select(*keep, F.col("prediction").alias("cluster"))


def rand_matrix(df: DataFrame, labelings: Sequence[str]) -> DataFrame:
    """CLU8: Rand index of every pair of labelings (a NULL is a label of its own): one scan.

    The joint counts of all labelings are one aggregate; grouping sets over them
    give the counts of each labeling and of each pair.  No pairs of rows.
    """
    names = [f"_l{i}" for i in range(len(labelings))]
    joint = df.select(*[F.col(c).alias(n) for c, n in zip(labelings, names)]).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    sets = [[F.col(names[i])] for i in range(len(names))] + [[F.col(names[i]), F.col(names[j])] for i, j in pairs]
    counts = joint.groupingSets(sets, *[F.col(n) for n in names]).agg(F.grouping_id().alias("_g"), F.sum("_n").cast("double").alias("_c"))
    rows = counts.groupBy("_g").agg(F.sum(F.col("_c") * (F.col("_c") - 1) / 2).alias("same"), F.sum("_c").alias("n")).collect()  # a row a set
    every = (1 << len(names)) - 1
    same = {every ^ r["_g"]: r["same"] for r in rows}  # by the labelings that take part, the first in the highest bit
    n = rows[0]["n"] if rows else 0.0
    bit = lambda i: 1 << (len(names) - 1 - i)
    total = n * (n - 1) / 2
    found = [(labelings[i], labelings[j], (total + 2 * same[bit(i) | bit(j)] - same[bit(i)] - same[bit(j)]) / total if total else None) for i, j in pairs]
    return small_frame(df.sparkSession, found, "labeling_a string, labeling_b string, rand_index double")


def rand_index(df: DataFrame, a: str, b: str) -> float | None:
    """CLU8 for two labelings; None for fewer than two rows."""
    return rand_matrix(df, [a, b]).first()["rand_index"]


def cluster_profiles(df: DataFrame, cluster: str, features: Sequence[str], target: str) -> DataFrame:
    """CLU9: mean (z-scored) feature per cluster, clusters ranked by mean target."""
    means = df.groupBy(cluster).agg(F.avg(target).alias("target_mean"), *[F.avg(c).alias(c) for c in features])
    # k rows: ranking the cluster means in one window is size-bounded
    order = means.select(cluster, "target_mean").withColumn(
        "cluster_rank", F.rank().over(Window.orderBy(F.desc("target_mean"), cluster)))
    long = means.unpivot([cluster, "target_mean"], list(features), "feature", "mean_z")
    return long.join(order.drop("target_mean"), cluster)


def neighbour_edges(points: DataFrame, d: int, n_neighbors: int, projections: int, reach: int, seed: int) -> DataFrame:
    """``(src, dst, d2)``: each row of ``points(id, x)`` with its nearest found rows.

    Rows are sorted along random directions by range partition, and each meets
    the next ``reach`` rows of the order: ``projections * reach`` pairs a row,
    whatever the number of rows, and no pair table of a bucket.
    """
    directions = np.random.default_rng(seed).normal(size=(projections, d))
    along = [F.struct(F.lit(i).alias("p"), sum((F.col("x")[j] * float(v) for j, v in enumerate(row)), F.lit(0.0)).alias("at"))
             for i, row in enumerate(directions)]
    lines = points.select("id", "x", F.explode(F.array(*along)).alias("line")).select("line.p", "line.at", "id", "x")
    ordered = lines.repartitionByRange("p", "at", "id").sortWithinPartitions("p", "at", "id")

    def run(batches):
        tail = None  # the last rows of the batch before
        for b in batches:
            p, i = b.column(0).to_numpy(), b.column(2).to_numpy()
            x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(i), d)
            new = np.ones(len(i), dtype=bool)
            if tail is not None:
                p, i, x = (np.concatenate([t, v]) for t, v in zip(tail, (p, i, x)))
                new = np.concatenate([np.zeros(len(p) - len(new), dtype=bool), new])
            found = []
            for step in range(1, reach + 1):
                at = np.flatnonzero((p[step:] == p[:-step]) & new[step:]) if len(p) > step else np.zeros(0, int)
                found.append((i[at], i[at + step], ((x[at] - x[at + step]) ** 2).sum(axis=1)))
            src, dst, d2 = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst), pa.array(d2)], names=["src", "dst", "d2"])
            tail = p[-reach:], i[-reach:], x[-reach:]

    met = ordered.mapInArrow(run, "src long, dst long, d2 double").where("src <> dst")
    both = met.unionAll(met.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "d2")).distinct()
    # each row has 2 * projections * reach candidates at most
    nearest = F.slice(F.array_sort(F.collect_list(F.struct("d2", "dst"))), 1, n_neighbors)
    return both.groupBy("src").agg(nearest.alias("es")).select("src", F.inline("es")).select("src", "dst", "d2")


def spectral(df: DataFrame, features: Sequence[str], k: int, n_neighbors: int = 10, projections: int = 8, reach: int = 16,
             seed: int = 0, max_iter: int = 40, keep: Sequence[str] = ()) -> DataFrame:
    """CLU7: power iteration clustering of all rows on a sparse neighbour graph.

    The graph is linear in the rows (:func:`neighbour_edges`); the iteration is
    MLlib's distributed one on the degree-normalised similarities.
    """
    from pyspark.ml.clustering import PowerIterationClustering

    ensure_checkpoint_dir(df.sparkSession)
    x = F.array(*[F.col(c).cast("double") for c in features])
    points = df.select(*keep, x.alias("_x")).where(" AND ".join(f"_x[{j}] IS NOT NULL" for j in range(len(features))))
    points = points.withColumn("_point", F.monotonically_increasing_id()).checkpoint()  # ids must not change between passes
    edges = neighbour_edges(points.select(F.col("_point").alias("id"), F.col("_x").alias("x")), len(features), n_neighbors, projections, reach, seed).checkpoint()
    scale = edges.agg(F.avg("d2")).first()[0] or 1.0
    graph = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"),
                         F.exp(-F.col("d2") / F.lit(2.0 * scale)).alias("weight")).distinct()
    found = PowerIterationClustering(k=k, maxIter=max_iter, initMode="random", weightCol="weight").assignClusters(graph)
    found = found.select(F.col("id").alias("_point"), F.col("cluster").alias("_found"))
    return points.join(found, "_point").select(*keep, F.col("_found").alias("cluster"))
