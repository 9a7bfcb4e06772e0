"""GRAM: the shared sufficient-statistics pass.

One distributed aggregation produces, for k columns, the (weighted) row count,
the means and the centred cross-product matrix ``S_ab = sum w (a - m_a)(b - m_b)``.
Covariance, correlation, PCA, OLS, VIF, condition numbers and every candidate of
a stepwise search are then k x k algebra on the driver: the rows are scanned
once, never once per model.

Physical shape:

* narrow, unweighted (k <= ``NARROW_K``): a single ``agg`` of ``avg`` and
  ``covar_pop`` expressions, which merge partial buffers with the stable
  pairwise update; partial aggregation runs map-side (one row per task is
  shuffled).
* weighted or wide: every Arrow batch gives its own weight, means and centred
  products by numpy; batches, tasks and groups of tasks are merged by the same
  pairwise update (:func:`merge_states`).  No statistic is ever taken about a
  value other than the mean of its own rows, so large means cost no digits.

Grouping (``by=``) gives one Gram per group (folds, bootstrap replicates,
feature groups of a panel) from the same single pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Up to NARROW_K columns the single-pass ``covar_pop`` aggregate wins; above it
# the k(k+1)/2 declarative aggregates outgrow whole-stage codegen (measured:
# 600k rows, k=9: 6.7 s vs 1.4 s; k=14: 16.7 s vs 1.5 s), so the numpy X'X
# per Arrow batch takes over.
NARROW_K = 6


@dataclass(frozen=True)
class Gram:
    """Sufficient statistics of k columns (complete cases only)."""

    columns: tuple[str, ...]
    n: float
    means: np.ndarray
    cross: np.ndarray  # centred sums of products, k x k
    rows: int = field(default=0)  # unweighted row count

    @property
    def k(self) -> int:
        return len(self.columns)

    def index(self, names: Iterable[str]) -> list[int]:
        pos = {c: i for i, c in enumerate(self.columns)}
        missing = [c for c in names if c not in pos]
        if missing:
            raise KeyError(f"columns not in Gram: {missing}")
        return [pos[c] for c in names]

    def sub(self, names: Sequence[str]) -> Gram:
        idx = self.index(names)
        return Gram(tuple(names), self.n, self.means[idx], self.cross[np.ix_(idx, idx)], self.rows)

    def cov(self, ddof: int = 1) -> np.ndarray:
        return self.cross / (self.n - ddof)

    def variances(self, ddof: int = 1) -> np.ndarray:
        return np.diag(self.cross) / (self.n - ddof)

    def corr(self) -> np.ndarray:
        """Pearson matrix; a zero-variance column gives NaN (reported as NULL)."""
        d = np.sqrt(np.diag(self.cross))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = self.cross / np.outer(d, d)
        r[~np.isfinite(r)] = np.nan
        np.fill_diagonal(r, np.where(d > 0, 1.0, np.nan))
        return r

    def raw_xtx(self, intercept: bool = True) -> np.ndarray:
        """Uncentred ``X'X`` of ``[1, x...]`` (or ``[x...]``) rebuilt from the centred form."""
        m = self.means
        inner = self.cross + self.n * np.outer(m, m)
        if not intercept:
            return inner
        top = np.concatenate([[self.n], self.n * m])
        return np.block([[top[None, :]], [np.column_stack([self.n * m, inner])]])

    def __add__(self, other: Gram) -> Gram:
        """Statistics of the rows of both."""
        if self.columns != other.columns:
            raise ValueError("Gram columns differ")
        if not self.n or not other.n:
            return other if not self.n else self
        n = self.n + other.n
        d = other.means - self.means
        return Gram(self.columns, n, self.means + d * (other.n / n),
                    self.cross + other.cross + np.outer(d, d) * (self.n * other.n / n), self.rows + other.rows)

    def __sub__(self, other: Gram) -> Gram:
        """Statistics of the rows in ``self`` but not in ``other``: the inverse of the sum."""
        if self.columns != other.columns:
            raise ValueError("Gram columns differ")
        n = self.n - other.n
        if n <= 0:
            raise ValueError("no rows are left")
        means = self.means + (self.means - other.means) * (other.n / n)
        d = other.means - means
        return Gram(self.columns, n, means, self.cross - other.cross - np.outer(d, d) * (n * other.n / self.n),
                    self.rows - other.rows)


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every listed column is non-NULL (NaN is treated as missing too)."""
    cond = None
    for c in cols:
        term = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        cond = term if cond is None else cond & term
    return df.filter(cond) if cond is not None else df


def gram(
    df: DataFrame,
    cols: Sequence[str],
    *,
    by: str | None = None,
    weight: str | Column | None = None,
    complete: bool = True,
) -> Gram | dict[object, Gram]:
    """Compute the Gram of ``cols``; with ``by`` a dict group value -> Gram."""
    cols = list(cols)
    if len(set(cols)) != len(cols):
        raise ValueError("duplicate columns in Gram")
    base = df.select(*([by] if by else []), *[F.col(c).cast("double").alias(c) for c in cols],
                     *([weight.alias("_w")] if isinstance(weight, Column) else
                       [F.col(weight).cast("double").alias("_w")] if weight else []))
    if complete:
        base = complete_cases(base, cols)
    if weight is None and len(cols) <= NARROW_K:
        return _gram_covar(base, cols, by)
    return _gram_states(base, cols, by, weighted=weight is not None)


def _gram_covar(base: DataFrame, cols: list[str], by: str | None) -> Gram | dict[object, Gram]:
    k = len(cols)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]
    for i in range(k):
        for j in range(i, k):
            aggs.append(F.covar_pop(cols[i], cols[j]).alias(f"_c{i}_{j}"))
    grouped = base.groupBy(by) if by else base
    rows = grouped.agg(*aggs).collect()  # one row per group: bounded by the number of groups
    out = {}
    for r in rows:
        n = float(r["_n"])
        means = np.array([r[f"_m{i}"] if r[f"_m{i}"] is not None else np.nan for i in range(k)], float)
        cross = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                v = r[f"_c{i}_{j}"]
                cross[i, j] = cross[j, i] = (v if v is not None else np.nan) * n
        out[r[by] if by else None] = Gram(tuple(cols), n, means, cross, int(n))
    if by:
        return out
    return out.get(None) or Gram(tuple(cols), 0.0, np.full(k, np.nan), np.full((k, k), np.nan), 0)


def merge_states(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Pairwise update of states ``[W, rows, means (k), centred products (k x k)]``, one or many at once (last axis)."""
    wa, wb = a[..., :1], b[..., :1]
    w = wa + wb
    share = np.divide(wb, w, out=np.zeros_like(w), where=w > 0)
    ma = np.where(wa > 0, a[..., 2:2 + k], b[..., 2:2 + k])
    d = np.where(wb > 0, b[..., 2:2 + k] - ma, 0.0)
    outer = (d[..., :, None] * d[..., None, :]).reshape(*d.shape[:-1], k * k)
    return np.concatenate([w, a[..., 1:2] + b[..., 1:2], ma + d * share, a[..., 2 + k:] + b[..., 2 + k:] + outer * (wa * share)], axis=-1)


def _batch_states(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One state a column of the weights ``w`` (rows x states)."""
    k, total, centre = x.shape[1], w.sum(axis=0), x.mean(axis=0)
    c = x - centre
    mean = (w.T @ c) / np.where(total > 0, total, 1.0)[:, None]
    products = w.T @ (c[:, :, None] * c[:, None, :]).reshape(len(x), k * k)
    drift = (mean[:, :, None] * mean[:, None, :]).reshape(len(total), k * k)
    return np.concatenate([total[:, None], (w > 0).sum(axis=0)[:, None], centre + mean, products - total[:, None] * drift], axis=1)


def _as_gram(cols: Sequence[str], v: np.ndarray) -> Gram:
    k = len(cols)
    return Gram(tuple(cols), float(v[0]), v[2:2 + k], v[2 + k:].reshape(k, k), int(v[1]))


def _reduce_states(states: DataFrame, merge, group_type: T.DataType) -> DataFrame:
    """Merge ``(g, state)`` rows to one per group, in two steps: a group's rows of many tasks never meet in one."""
    schema = T.StructType([T.StructField("g", group_type), T.StructField("state", T.ArrayType(T.DoubleType()))])

    def fold(table: pa.Table) -> pa.Table:
        rows = [np.array(v, float) for v in table["state"].to_pylist()]
        while len(rows) > 1:  # a balanced tree, for the least rounding
            rows = [merge(*rows[i:i + 2]) if i + 1 < len(rows) else rows[i] for i in range(0, len(rows), 2)]
        return table.select(["g"]).slice(0, 1).append_column("state", pa.array([rows[0].tolist()], pa.list_(pa.float64())))

    lanes = F.pmod(F.col("part"), F.lit(max(1, int(states.sparkSession.conf.get("spark.sql.shuffle.partitions"))))).alias("lane")
    near = states.groupBy("g", lanes).applyInArrow(fold, schema)
    return near.groupBy("g").applyInArrow(fold, schema)


def _task_states(base: DataFrame, cols: list[str], by: str | None, weighted: bool, state, merge, counts=None) -> DataFrame:
    """One ``(g, part, state)`` row per task and group."""
    key_type = base.schema[by].dataType if by else T.StringType()
    schema = T.StructType([T.StructField("g", key_type), T.StructField("part", T.IntegerType()),
                           T.StructField("state", T.ArrayType(T.DoubleType()))])

    def partial(batches):
        from pyspark import TaskContext

        acc: dict = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols])
            if not weighted:
                wv = np.ones((b.num_rows, 1))
            elif counts:
                wv = counts(b.column("_w")).astype(float)
            else:
                wv = b.column("_w").to_numpy(zero_copy_only=False).astype(float)[:, None]
            if by:
                codes = b.column(by).dictionary_encode(null_encoding="encode")
                inv = codes.indices.to_numpy(zero_copy_only=False)
                order = np.argsort(inv, kind="stable")
                bounds = np.cumsum(np.bincount(inv, minlength=len(codes.dictionary)))[:-1]
                groups = list(zip(codes.dictionary.to_pylist(), np.split(order, bounds)))
            else:
                groups = [(None, slice(None))]
            for g, sel in groups:
                part = state(x[sel], wv[sel])
                acc[g] = merge(acc[g], part) if g in acc else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(acc), type=to_arrow_type(key_type)), pa.array([TaskContext.get().partitionId()] * len(acc), pa.int32()),
             pa.array([v.tolist() for v in acc.values()], pa.list_(pa.float64()))], names=["g", "part", "state"])

    return base.mapInArrow(partial, schema)


def _gram_states(base: DataFrame, cols: list[str], by: str | None, weighted: bool) -> Gram | dict[object, Gram]:
    k = len(cols)
    found = _merged_states(base, cols, by, weighted, lambda x, w: _batch_states(x, w).ravel(), 1)
    out = {g: _as_gram(cols, v[0]) for g, v in found.items() if v[0, 0] > 0}
    if by:
        return out
    return out.get(None) or Gram(tuple(cols), 0.0, np.full(k, np.nan), np.full((k, k), np.nan), 0)


def _merged_states(base: DataFrame, cols: list[str], by: str | None, weighted: bool, state, count: int, counts=None) -> dict[object, np.ndarray]:
    """``count`` states of each group, one after the other in a row."""
    k = len(cols)

    def merge(a, b):
        return merge_states(a.reshape(count, -1), b.reshape(count, -1), k).ravel()

    states = _task_states(base, cols, by, weighted, state, merge, counts)
    rows = _reduce_states(states, merge, states.schema["g"].dataType).collect()  # a row a group
    return {r["g"]: np.array(r["state"], float).reshape(count, -1) for r in rows}


def replicate_grams(df: DataFrame, cols: Sequence[str], key: Column, counts: Callable[[pa.Array], np.ndarray], n: int, by: str | None = None):
    """Grams of ``n`` weighted replicates, and of the rows that each leaves out, from one scan.

    ``counts`` gives a batch's weights (rows x ``n``) from its ``key`` strings,
    where the batch is: no array of weights goes with a row.  A batch's statistics
    for all replicates are one product of its weight matrix with its products of
    columns: no row is copied per replicate.  Returns ``[(in, out), ...]``, with
    ``by`` a dict of such lists.
    """
    cols = list(cols)
    base = complete_cases(df.select(*([by] if by else []), *[F.col(c).cast("double").alias(c) for c in cols], key.alias("_w")), cols)

    def state(x, w):
        return _batch_states(x, np.concatenate([w, (w == 0).astype(float)], axis=1)).ravel()

    found = {g: [(_as_gram(cols, v[i]), _as_gram(cols, v[n + i])) for i in range(n)]
             for g, v in _merged_states(base, cols, by, True, state, 2 * n, counts).items()}
    return found if by else found.get(None, [])


def pairwise_corr(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson matrix with pairwise-complete rows (pandas ``DataFrame.corr`` semantics).

    NaN counts as missing and a constant column gives NaN, on the diagonal too,
    for any number of columns.  For every pair the state holds, over the rows
    where both are present, their number, means, centred squares and products:
    with ``M`` the presence mask and ``X0`` the batch's centred values (0 where
    missing) these are the matrices ``M'M``, ``X0'M``, ``(X0^2)'M`` and ``X0'X0``
    of one Arrow batch, merged by the pairwise update.
    """
    cols = list(cols)
    k = len(cols)
    kk = k * k
    base = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])

    def state(x, _):
        m = ~np.isnan(x)
        mf = m.astype(float)
        seen = np.maximum(mf.sum(axis=0), 1.0)
        centre = np.where(m, x, 0.0).sum(axis=0) / seen
        x0 = np.where(m, x - centre, 0.0)
        n = mf.T @ mf
        at = np.maximum(n, 1.0)
        s = x0.T @ mf
        mean = np.where(n > 0, centre[:, None] + s / at, 0.0)
        return np.concatenate([n.ravel(), mean.ravel(), ((x0 * x0).T @ mf - s * s / at).ravel(), (x0.T @ x0 - s * s.T / at).ravel()])

    def merge(a, b):
        na, ma, va, ca = (a[i * kk:(i + 1) * kk].reshape(k, k) for i in range(4))
        nb, mb, vb, cb = (b[i * kk:(i + 1) * kk].reshape(k, k) for i in range(4))
        n = na + nb
        at = np.maximum(n, 1.0)
        d = np.where((na > 0) & (nb > 0), mb - ma, 0.0)
        mean = np.where(na > 0, ma, mb) + d * (nb / at)
        f = na * nb / at
        return np.concatenate([n.ravel(), mean.ravel(), (va + vb + d * d * f).ravel(), (ca + cb + d * d.T * f).ravel()])

    states = _task_states(base, cols, None, False, state, merge)
    rows = _reduce_states(states, merge, states.schema["g"].dataType).collect()  # one row
    r = np.full((k, k), np.nan)
    if rows:
        n, _, v, c = (np.array(rows[0]["state"], float)[i * kk:(i + 1) * kk].reshape(k, k) for i in range(4))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = np.where((v > 0) & (v.T > 0), c / np.sqrt(v * v.T), np.nan)
        np.fill_diagonal(r, np.where((np.diag(v) > 0) & (np.diag(n) > 1), 1.0, np.nan))
    return r
