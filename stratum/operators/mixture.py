"""Gaussian mixtures by expectation maximisation, several starts in one scan a round (CLU6).

A round reads the points once: every task gets the log densities of its rows
from the Cholesky factors of all components of all starts, and hands on for
each component the weight, the weighted differences from its mean and their
products.  Moments are about the current mean, so no digits are lost far from
zero.  A start stops when its mean log-likelihood grows by ``tol`` or less;
it never falls, since each round is a full maximisation step (up to ``reg``,
which is added to the diagonal of every covariance).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lloyd import Fit, vectors

TOL = 1e-9
MAX_ROUNDS = 1000
REG = 1e-6
_ROWS = 1 << 14


@dataclass
class Mixture:
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray
    #: mean log-likelihood of a row before each step
    path: list[float] = field(default_factory=list)
    converged: bool = False

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        """Log of weight times density, rows x components."""
        out = np.empty((len(x), len(self.weights)))
        for c, (w, m, s) in enumerate(zip(self.weights, self.means, self.covs)):
            low = np.linalg.cholesky(s)
            z = np.linalg.solve(low, (x - m).T)
            out[:, c] = np.log(max(w, 1e-300)) - 0.5 * (z * z).sum(axis=0) - np.log(np.diag(low)).sum() - 0.5 * len(m) * np.log(2 * np.pi)
        return out


def start_from(fit: Fit, spread: np.ndarray) -> Mixture:
    """Equal weights, the centres of a k-means fit, and one covariance for all."""
    return Mixture(np.full(fit.k, 1 / fit.k), fit.centers.copy(), np.repeat(spread[None], fit.k, axis=0))


def _responsibilities(m: Mixture, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = m.log_densities(x)
    top = d.max(axis=1, keepdims=True)
    total = top[:, 0] + np.log(np.exp(d - top).sum(axis=1))
    return np.exp(d - total[:, None]), total


def _step(points: DataFrame, held: Sequence[Mixture], d: int) -> tuple[dict[tuple[int, int], tuple[float, np.ndarray, np.ndarray]], list[float], int]:
    """Weight, differences and products of each (start, component), log-likelihood of each start, and rows."""
    sent = points.sparkSession.sparkContext.broadcast([Mixture(m.weights, m.means, m.covs) for m in held])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(m.weights), 3 + d + d * d)) for m in sent.value]
        for batch in batches:
            x_all = vectors(batch.column(0)) if batch.num_rows else np.zeros((0, d))
            for lo in range(0, len(x_all), _ROWS):
                x = x_all[lo:lo + _ROWS]
                for m, s in zip(sent.value, sums):
                    r, ll = _responsibilities(m, x)
                    s[0, 0] += ll.sum()
                    s[0, 1] += len(x)
                    s[:, 2] += r.sum(axis=0)
                    for c in range(len(m.weights)):
                        e = x - m.means[c]
                        s[c, 3:3 + d] += r[:, c] @ e
                        s[c, 3 + d:] += ((e * r[:, c:c + 1]).T @ e).ravel()
        which = np.concatenate([np.full(len(s), i) for i, s in enumerate(sums)])
        comp = np.concatenate([np.arange(len(s)) for s in sums])
        flat = np.concatenate(sums)
        yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(comp), *(pa.array(np.ascontiguousarray(v)) for v in flat.T)],
                                         names=["start", "c", *[f"v{j}" for j in range(flat.shape[1])]])

    width = 3 + d + d * d
    schema = "start long, c long" + "".join(f", v{j} double" for j in range(width))
    rows = points.select("x").mapInArrow(run, schema).groupBy("start", "c").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(width)]).collect()
    found, total, n = {}, [0.0] * len(held), 0
    for r in rows:  # a row a component
        v = np.array(r[2:], dtype=float)
        found[r["start"], r["c"]] = v[2], v[3:3 + d], v[3 + d:].reshape(d, d)
        total[r["start"]] += v[0]
        n = max(n, int(v[1]))
    return found, total, n


def fit_mixtures(points: DataFrame, starts: Sequence[Mixture], tol: float = TOL, max_rounds: int = MAX_ROUNDS, reg: float = REG) -> list[Mixture]:
    """Each start run to convergence; ``points`` holds the vector ``x``."""
    held = [Mixture(m.weights.copy(), m.means.copy(), m.covs.copy()) for m in starts]
    d = held[0].means.shape[1]
    for _ in range(max_rounds):
        moving = [m for m in held if not m.converged]
        if not moving:
            break
        found, total, n = _step(points, moving, d)
        if not n:
            break
        for i, m in enumerate(moving):
            m.path.append(total[i] / n)
            m.converged = len(m.path) > 1 and m.path[-1] - m.path[-2] <= tol
            if m.converged:
                continue
            for c in range(len(m.weights)):
                w, s, q = found[i, c]
                m.weights[c] = w / n
                if w > 1e-8:  # an empty component stays where it is
                    shift = s / w
                    m.means[c] = m.means[c] + shift
                    m.covs[c] = q / w - np.outer(shift, shift) + reg * np.eye(d)
    return held


def best_mixture(points: DataFrame, fits: Sequence[Fit], **options) -> Mixture:
    """The mixture of greatest likelihood among those started at the centres of ``fits`` (all of one k)."""
    d = fits[0].centers.shape[1]
    cols = [F.col("x")[j] for j in range(d)]
    row = points.agg(*[F.covar_pop(a, b).alias(f"c{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols)]).first()
    spread = np.array([[row[f"c{i}_{j}"] or 0.0 for j in range(d)] for i in range(d)]) + REG * np.eye(d)
    held = fit_mixtures(points, [start_from(f, spread) for f in fits], **options)
    return max(held, key=lambda m: m.path[-1] if m.path else -np.inf)


def assign(points: DataFrame, mixture: Mixture, keep: Sequence[str] = (), name: str = "cluster") -> DataFrame:
    """``keep`` columns and the likeliest component (ties: the first) of every row of ``points``."""
    sent = points.sparkSession.sparkContext.broadcast(Mixture(mixture.weights, mixture.means, mixture.covs))
    source = points.select(*keep, "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = sent.value.log_densities(vectors(batch.column(len(keep)))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own.astype(np.int32))], names=[*keep, name])

    return source.mapInArrow(run, source.select(*keep, F.lit(0).alias(name)).schema)
