"""Many k-means fits in one scan a round (CLU1-CLU3).

All fits that are still moving, whatever their ``k`` and start, are advanced
together: a round reads the points once, every task assigns its rows to the
nearest centre of each fit with numpy passes, and hands on for each centre the
count, the sum of differences from the centre, and their squares.  A fit
stops when no centre moves by more than ``tol`` of the data's spread.  What is
sent around is one row a centre: ``fits * k * d`` numbers.

``silhouettes`` gives the mean silhouette of any number of fits with two more
scans: sums of the clusters, then ``O(k)`` work a row and fit from these sums,
for squared distances; no pairs of rows.

Rows with a NULL feature belong to no cluster.  A centre that loses all rows
stays where it is.
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

TOL = 1e-10
MAX_ROUNDS = 500
STARTS = 10
#: rows that a pass takes at once
_ROWS = 1 << 12


@dataclass
class Fit:
    centers: np.ndarray
    inertia: float = float("inf")
    sizes: np.ndarray | None = None
    rounds: int = 0
    converged: bool = False

    @property
    def k(self) -> int:
        return len(self.centers)


def as_points(df: DataFrame, features: Sequence[str] | str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and the vector ``x`` of every row without NULLs among ``features`` (columns, or one array column)."""
    if isinstance(features, str):
        x = F.col(features).cast("array<double>")
        if df.where(F.col(features).isNotNull()).agg(F.count_distinct(F.size(features))).first()[0] > 1:
            raise ValueError(f"vectors of {features!r} differ in length")
    else:
        x = F.array(*[F.col(c).cast("double") for c in features])
    rows = df.select(*keep, x.alias("x"))
    return rows.where("x IS NOT NULL AND NOT exists(x, v -> v IS NULL)")


def vectors(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest centre of each row (ties: the first) and the squared distance."""
    best, dist = np.zeros(len(x), dtype=np.int64), np.empty(len(x))
    for a in range(0, len(x), _ROWS):
        columns = np.ascontiguousarray(x[a:a + _ROWS].T)
        own, least = best[a:a + _ROWS], dist[a:a + _ROWS]
        least[:] = np.inf
        d, e = np.empty(len(own)), np.empty(len(own))
        for c, center in enumerate(centers):  # a few rows' numbers, all in the processor's cache
            d[:] = 0.0
            for v, at in zip(columns, center):
                np.subtract(v, at, out=e)
                e *= e
                d += e
            np.copyto(own, c, where=d < least)
            np.minimum(least, d, out=least)
    return best, dist


def _sums(x: np.ndarray, fits: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """For each fit and centre: rows nearest to it (ties: the first), their squared distances, and their differences from it."""
    columns, middle = np.ascontiguousarray(x.T), x.mean(axis=0)
    parts = np.column_stack([np.ones(len(x)), np.zeros(len(x)), x - middle])  # about the middle: no digits are lost far from zero
    d, e = np.empty((max(len(c) for c in fits), len(x))), np.empty(len(x))
    for centers in fits:
        for to, center in zip(d, centers):
            to[:] = 0.0
            for v, at in zip(columns, center):
                np.subtract(v, at, out=e)
                e *= e
                to += e
        least = np.minimum.reduce(d[:len(centers)], axis=0)
        own = d[:len(centers)] == least
        if np.count_nonzero(own) > len(x):
            own &= np.cumsum(own, axis=0) == 1
        parts[:, 1] = least
        found = own.astype(float) @ parts
        found[:, 2:] -= found[:, :1] * (centers - middle)
        yield found


def _packed(points: DataFrame, d: int) -> DataFrame:
    """The vectors of ``points`` written as blocks of up to ``_ROWS`` rows: a round reads a few long values and no arrays row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors(batch.column(0)) if batch.num_rows else np.zeros((0, d))
            blocks = [np.ascontiguousarray(x[a:a + _ROWS], dtype="<f8").tobytes() for a in range(0, len(x), _ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["block"])

    return checkpointed(points.select("x").mapInArrow(run, "block binary"))


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    """Rows of vectors, from packed blocks or from a list column."""
    if pa.types.is_list(batch.column(0).type):
        if batch.num_rows:
            yield vectors(batch.column(0))
        return
    for block in batch.column(0):
        yield np.frombuffer(block.as_buffer(), dtype="<f8").reshape(-1, d)


def _spread(blocks: DataFrame, d: int) -> float:
    """The widest range of a feature over all rows, whatever rows the starts happen to be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _blocks(batch, d):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))], names=["j", "lo", "hi"])

    ranges = blocks.mapInArrow(run, "j long, lo double, hi double").groupBy("j").agg((F.max("hi") - F.min("lo")).alias("w"))
    return ranges.agg(F.max("w")).first()[0] or 0.0


def _round(points: DataFrame, fits: Sequence[np.ndarray], d: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each fit: rows, sums of differences and of squared distances by centre."""
    sent = points.sparkSession.sparkContext.broadcast(list(fits))
    columns = [f"s{j}" for j in range(d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = sent.value
        total = [np.zeros((len(c), d + 2)) for c in centers]
        for batch in batches:
            for whole in _blocks(batch, d):
                for a in range(0, len(whole), _ROWS):
                    for t, s in zip(total, _sums(whole[a:a + _ROWS], centers)):
                        t += s
        flat = np.concatenate(total)
        fit = np.repeat(np.arange(len(centers)), [len(c) for c in centers])
        center = np.concatenate([np.arange(len(c)) for c in centers])
        yield pa.RecordBatch.from_arrays([pa.array(fit), pa.array(center), *(pa.array(np.ascontiguousarray(v)) for v in flat.T)],
                                         names=["fit", "center", "n", "q", *columns])

    schema = "fit long, center long, n double, q double" + "".join(f", {c} double" for c in columns)
    rows = (points.mapInArrow(run, schema).groupBy("fit", "center")
            .agg(*[F.sum(c).alias(c) for c in ("n", "q", *columns)]).collect())  # a row a centre
    out = [(np.zeros(len(c)), np.zeros((len(c), d)), np.zeros(len(c))) for c in fits]
    for r in rows:
        n, s, q = out[r["fit"]]
        n[r["center"]], q[r["center"]], s[r["center"]] = r["n"], r["q"], [r[c] for c in columns]
    return out


def fit_many(points: DataFrame, starts: Sequence[np.ndarray], tol: float = TOL, max_rounds: int = MAX_ROUNDS) -> list[Fit]:
    """Lloyd's rounds from each of ``starts`` (k x d centres) to convergence; ``points`` holds the vector ``x``."""
    fits = [Fit(np.array(s, dtype=float)) for s in starts]
    if not fits:
        return fits
    d = fits[0].centers.shape[1]
    blocks = _packed(points, d)
    least = tol * _spread(blocks, d)
    for _ in range(max_rounds + 1):
        moving = [f for f in fits if not f.converged]
        if not moving:
            break
        for f, (n, s, q) in zip(moving, _round(blocks, [f.centers for f in moving], d)):
            f.sizes, f.inertia = n.astype(np.int64), float(q.sum())
            shift = s / np.maximum(n, 1)[:, None]
            # a step below the last digits of the centres is none
            f.converged = bool(np.abs(shift).max() <= max(least, 4 * np.finfo(float).eps * np.abs(f.centers).max())) or f.rounds == max_rounds
            if not f.converged:
                f.centers, f.rounds = f.centers + shift, f.rounds + 1
    return fits


def hashed_starts(df: DataFrame, features: Sequence[str], key: Sequence[str], k: int, n_init: int, seed: int = 0) -> list[np.ndarray]:
    """For each start the ``k`` rows of the smallest md5 of seed, start and key: reruns and engines agree."""
    points = as_points(df, features, keep=key)
    parts = None
    for s in range(n_init):
        h = F.md5(F.concat_ws("|", F.lit(f"{seed}|{s}"), *[F.col(c).cast("string") for c in key]))
        part = points.select(F.lit(s).alias("start"), h.alias("h"), "x").orderBy("h").limit(k)
        parts = part if parts is None else parts.unionAll(part)
    out: list[list] = [[] for _ in range(n_init)]
    for r in sorted(parts.collect(), key=lambda r: (r["start"], r["h"])):  # n_init * k rows
        out[r["start"]].append(r["x"])
    return [np.array(rows) for rows in out]


def best_by_k(df: DataFrame, features: Sequence[str], key: Sequence[str], ks: Sequence[int], n_init: int = STARTS, seed: int = 0,
              tol: float = TOL) -> tuple[DataFrame, dict[int, Fit]]:
    """The written points and for each ``k`` the fit of least inertia (ties: the first start), all fits in the same scans."""
    points = checkpointed(as_points(df, features, keep=key))
    most = hashed_starts(points.select(*key, *[F.col("x")[j].alias(f) for j, f in enumerate(features)]), features, key, max(ks), n_init, seed)
    starts = [(k, s[:k]) for k in ks for s in most if len(s) >= k]
    best: dict[int, Fit] = {}
    for (k, _), fit in zip(starts, fit_many(points, [s for _, s in starts], tol)):
        if k not in best or fit.inertia < best[k].inertia * (1 - 1e-12):
            best[k] = fit
    return points, best


def elbow(df: DataFrame, features: Sequence[str], key: Sequence[str], ks: Sequence[int], n_init: int = STARTS, seed: int = 0) -> DataFrame:
    """CLU2: least inertia by k."""
    _, best = best_by_k(df, features, key, ks, n_init, seed)
    return small_frame(df.sparkSession, [(int(k), best[k].inertia) for k in ks if k in best], "k int, inertia double")


def silhouettes(points: DataFrame, fits: Sequence[Fit]) -> list[float | None]:
    """Mean silhouette (squared distances; clusters of one row count 0) of each fit over all rows: one scan."""
    d = fits[0].centers.shape[1]
    sums = _round(points.select("x"), [f.centers for f in fits], d)
    sent = points.sparkSession.sparkContext.broadcast([(f.centers, *s) for f, s in zip(fits, sums)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(sent.value)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vectors(batch.column(0))
            rows += len(x)
            for i, (centers, n, s, q) in enumerate(sent.value):
                own, _ = nearest(x, centers)
                to = np.empty((len(x), len(centers)))  # summed squared distances to a cluster's rows, about its centre
                for c in range(len(centers)):
                    e = x - centers[c]
                    to[:, c] = n[c] * (e * e).sum(axis=1) - 2 * e @ s[c] + q[c]
                at = np.arange(len(x))
                a = to[at, own] / np.maximum(n[own] - 1, 1)
                other = np.where(n > 0, to / np.maximum(n, 1), np.inf)
                other[at, own] = np.inf
                b = other.min(axis=1)
                top = np.maximum(a, b)
                total[i] += np.where((n[own] <= 1) | (top == 0) | ~np.isfinite(b), 0.0, (b - a) / np.where(top == 0, 1, top)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), rows))], names=["fit", "s", "n"])

    rows = points.select("x").mapInArrow(run, "fit long, s double, n long").groupBy("fit").agg((F.sum("s") / F.sum("n")).alias("mean")).collect()
    found = {r["fit"]: r["mean"] for r in rows}
    return [found.get(i) for i in range(len(fits))]


def silhouette_by_k(df: DataFrame, features: Sequence[str], key: Sequence[str], ks: Sequence[int], n_init: int = STARTS, seed: int = 0) -> DataFrame:
    """CLU3: mean silhouette of the best fit of each k."""
    points, best = best_by_k(df, features, key, ks, n_init, seed)
    ks = [k for k in ks if k in best]
    means = silhouettes(points, [best[k] for k in ks]) if ks else []
    return small_frame(df.sparkSession, [(int(k), m) for k, m in zip(ks, means)], "k int, silhouette_sq double")


def assign(points: DataFrame, centers: np.ndarray, keep: Sequence[str] = (), name: str = "cluster") -> DataFrame:
    """``keep`` columns and the nearest centre of every row of ``points``."""
    sent = points.sparkSession.sparkContext.broadcast(np.asarray(centers, dtype=float))
    source = points.select(*keep, "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = nearest(vectors(batch.column(len(keep))), sent.value)[0]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own.astype(np.int32))], names=[*keep, name])

    return source.mapInArrow(run, source.select(*keep, F.lit(0).alias(name)).schema)
