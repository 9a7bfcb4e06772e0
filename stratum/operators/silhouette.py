"""Silhouettes with Euclidean distances (CLU3, CLU4).

The mean distance of a row to a cluster has no closed form, and all pairs of
rows would be quadratic.  Each cluster is stood for by the ``sample`` of its rows
with the smallest md5 of seed and key, so every row meets clusters times
``sample`` rows whatever the size of the table, and engines agree on them.  A
cluster of up to ``sample`` rows is taken whole: then the silhouette is exact.
Beyond it ``std_err`` is the standard error of the estimate, from the spread of
the distances, the share of the cluster that was seen, and both distances' part
in the silhouette.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..frames import small_frame
from .lloyd import STARTS, as_points, assign, best_by_k, vectors

SAMPLE = 256
#: distances held at once
_CELLS = 1 << 20


def _distances(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances from the differences: a row's distance to itself is exactly 0."""
    d2 = np.zeros((len(x), len(rows)))
    for j in range(x.shape[1]):
        e = x[:, j, None] - rows[None, :, j]
        d2 += e * e
    return np.sqrt(d2)


def _to_cluster(x: np.ndarray, rows: np.ndarray, size: int, own: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean distance to a cluster's other rows and its standard error, from the rows seen of it."""
    mean, err = np.empty(len(x)), np.empty(len(x))
    step = max(1, _CELLS // len(rows))
    for at in range(0, len(x), step):
        part = slice(at, at + step)
        d = _distances(x[part], rows)
        seen, others = len(rows) - inside[part].astype(float), size - own[part].astype(float)
        m = d.sum(axis=1) / np.maximum(seen, 1)
        square = ((d - m[:, None]) ** 2).sum(axis=1) - np.where(inside[part], m * m, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            e = np.sqrt(np.maximum(square, 0) / (seen - 1) / seen * (1 - seen / others))
        mean[part], err[part] = m, np.where(seen >= others, 0.0, e)
    return mean, err


def _of_rows(x: np.ndarray, own: np.ndarray, inside: np.ndarray, samples: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Silhouette of each row and its standard error; 0 in a cluster of one row or where there is one cluster."""
    at = np.arange(len(x))
    found = [_to_cluster(x, rows, n, own == c, inside & (own == c)) for c, (rows, n) in enumerate(zip(samples, sizes))]
    mean, err = (np.stack(v, axis=1) for v in zip(*found))
    a, ea = mean[at, own], err[at, own]
    mean[at, own] = np.inf
    near = mean.argmin(axis=1)
    b, eb = mean[at, near], err[at, near]
    none = (np.array(sizes)[own] <= 1) | ~np.isfinite(b) | (np.maximum(a, b) == 0)
    top = np.where(none, 1.0, np.maximum(a, b))
    low = np.minimum(a, b)
    spread = np.where(a < b, np.hypot(ea, low / top * eb), np.hypot(eb, low / top * ea)) / top
    return np.where(none, 0.0, (b - a) / top), np.where(none, 0.0, spread)


def silhouette(df: DataFrame, features: Sequence[str] | str, cluster: str, key: Sequence[str], sample: int = SAMPLE, seed: int = 0) -> DataFrame:
    """CLU4: ``key``, ``cluster``, ``silhouette`` and ``std_err`` of every row (``key`` identifies a row).

    Rows without a label or with a NULL among their features are left out.
    """
    if sample < 3:
        raise ValueError("a cluster needs a sample of three rows or more")
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    points = as_points(df.where(F.col(cluster).isNotNull()).withColumn("_h", h), features, keep=[*key, cluster, "_h"])
    first = F.row_number().over(Window.partitionBy(cluster).orderBy("_h", *key))  # limited before the shuffle
    seen = points.withColumn("_n", first).where(F.col("_n") <= sample).select(cluster, "_h", "x").collect()  # clusters x sample rows
    counts = {r[0]: r[1] for r in points.groupBy(cluster).count().collect()}
    labels = sorted(counts)
    samples = [np.array([r["x"] for r in seen if r[cluster] == c], dtype=float) for c in labels]
    last = [max(r["_h"] for r in seen if r[cluster] == c) for c in labels]
    sent = df.sparkSession.sparkContext.broadcast((samples, [counts[c] for c in labels], labels, last))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sizes, names, bounds = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            *kept, marks, hashed, x = batch.columns
            own = pc.index_in(marks, value_set=pa.array(names, marks.type)).to_numpy()
            inside = pc.less_equal(hashed, pa.array(bounds, hashed.type).take(pa.array(own))).to_numpy(zero_copy_only=False)
            value, error = _of_rows(vectors(x), own, inside, rows, sizes)
            yield pa.RecordBatch.from_arrays([*kept, marks, pa.array(value), pa.array(error)], names=[*key, cluster, "silhouette", "std_err"])

    out = points.select(*key, cluster, F.lit(0.0).alias("silhouette"), F.lit(0.0).alias("std_err")).schema
    return points.select(*key, cluster, "_h", "x").mapInArrow(run, out)


def by_k(df: DataFrame, features: Sequence[str], key: Sequence[str], ks: Sequence[int], n_init: int = STARTS, sample: int = SAMPLE,
         seed: int = 0) -> DataFrame:
    """CLU3: mean silhouette of the best k-means fit of each k, and the mean standard error of its rows."""
    points, best = best_by_k(df, features, key, ks, n_init, seed)
    rows = []
    for k in (k for k in ks if k in best):  # a handful of fits; each takes one scan
        found = silhouette(assign(points, best[k].centers, keep=[*key, "x"]), "x", "cluster", key, sample, seed)
        mean, error = found.agg(F.avg("silhouette"), F.avg("std_err")).first()
        rows.append((int(k), mean, error))
    return small_frame(df.sparkSession, rows, "k int, silhouette double, std_err double")
