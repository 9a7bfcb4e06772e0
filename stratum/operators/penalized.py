"""Elastic net on sufficient statistics, with categories as counts (OLS12).

One scan gives, for every fold and combination of levels, the rows, means and
products of the numeric columns and the target.  A category's block of the Gram
is made of counts, its products with numeric columns are sums: no dummy is ever
a column of the rows.  Everything after that is algebra on ``p x p`` numbers
(``p``: levels and numeric columns): folds are taken out of the whole by
subtraction, a path of penalties is followed down with warm starts by coordinate
descent, and the penalty of least error over the folds left out is refitted on
all rows, to a violation of the optimality conditions below ``KKT``.

The objective is ``1/(2n) |y - b0 - X b|^2 + penalty * (mix |s b|_1 + (1 - mix)/2 |s b|^2)``
with ``s`` the standard deviations of the columns (dummies too); every level has a
coefficient, none is left out.  Rows with a NULL number or target are left out; a
NULL category is a level of its own; a level without training rows has effect 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashrand import uniform
from ..session import checkpointed

KKT = 1e-9
#: while penalties are compared
ROUGH = 1e-6
PENALTIES = 50
SHORTEST = 1e-3


@dataclass
class Moments:
    """Counts, sums and products about fixed centres; the target is the last column."""

    n: float
    s: np.ndarray
    q: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.s + other.s, self.q + other.q)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.s - other.s, self.q - other.q)

    def standardized(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Correlations of the terms, their covariances with the target over their deviations, deviations, means."""
        mean = self.s / self.n
        cov = self.q / self.n - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov)[:-1], 0.0))
        sd[sd <= 1e-12 * np.sqrt(np.maximum(np.diag(self.q)[:-1] / self.n, 1e-300))] = 0.0  # constant: no effect
        unit = np.where(sd > 0, sd, 1.0)
        return np.where(np.outer(sd, sd) > 0, cov[:-1, :-1] / np.outer(unit, unit), 0.0), np.where(sd > 0, cov[:-1, -1] / unit, 0.0), sd, mean


def descend(r: np.ndarray, c: np.ndarray, penalty: float, mix: float, start: np.ndarray, kkt: float = KKT, max_rounds: int = 100_000) -> np.ndarray:
    """Coordinate descent on standardised moments until the optimality conditions hold to ``kkt``."""
    beta = start.copy()
    used = np.flatnonzero(np.diag(r) > 0)
    rest = c - r @ beta  # correlation of each column with what is left
    scale = max(float(np.abs(c).max(initial=0.0)), 1e-300)
    for _ in range(max_rounds):
        for j in used:
            z = rest[j] + r[j, j] * beta[j]
            new = np.sign(z) * max(abs(z) - penalty * mix, 0.0) / (r[j, j] + penalty * (1 - mix))
            if new != beta[j]:
                rest -= r[:, j] * (new - beta[j])
                beta[j] = new
        if violation(r, c, penalty, mix, beta) <= kkt * scale:
            break
    return beta


def violation(r: np.ndarray, c: np.ndarray, penalty: float, mix: float, beta: np.ndarray) -> float:
    """How far the optimality conditions are from holding."""
    used = np.diag(r) > 0
    g = c - r @ beta - penalty * (1 - mix) * beta
    bad = np.where(beta != 0, np.abs(g - penalty * mix * np.sign(beta)), np.maximum(np.abs(g) - penalty * mix, 0.0))
    return float(bad[used].max(initial=0.0))


@dataclass
class Net:
    """Coefficients of numeric columns and of every level (``None`` is the NULL level)."""

    intercept: float
    numeric: dict[str, float]
    levels: dict[str, dict]
    penalty: float
    cv_rmse: list[tuple[float, float]]
    beta: np.ndarray
    moments: Moments

    def effects(self, df: DataFrame, name: str = "fitted") -> DataFrame:
        """``df`` with the fitted value; levels are looked up by joins."""
        out = df
        total = F.lit(self.intercept)
        for c, b in self.numeric.items():
            total = total + F.col(c).cast("double") * F.lit(b)
        for i, (c, found) in enumerate(self.levels.items()):
            kind = df.schema[c].dataType.simpleString()
            table = df.sparkSession.createDataFrame([(v, b) for v, b in found.items()], f"_level{i} {kind}, _effect{i} double")
            out = out.join(table, F.col(c).eqNullSafe(F.col(f"_level{i}")), "left")
            total = total + F.coalesce(F.col(f"_effect{i}"), F.lit(0.0))
        return out.select(*df.columns, total.alias(name))


def cells(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str], fold: Column, folds: int) -> tuple[list[Moments], list[tuple[str, object]], np.ndarray]:
    """Moments of each fold, the levels in column order, and the centres of numeric columns and target: one scan."""
    cols = [f"_x{i}" for i in range(len(numeric))] + ["_y"]
    keys = [f"_c{i}" for i in range(len(categorical))]
    source = df.select(fold.cast("int").alias("_fold"), *[F.col(c).alias(k) for c, k in zip(categorical, keys)],
                       *[F.col(c).cast("double").alias(k) for c, k in zip([*numeric, target], cols)]).dropna(subset=cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    rows = source.groupBy("_fold", *keys).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                                             *[F.covar_pop(cols[i], cols[j]).alias(f"v{i}_{j}") for i, j in pairs]).collect()  # a row a fold and combination of levels
    levels = [(c, v) for i, c in enumerate(categorical) for v in sorted({r[f"_c{i}"] for r in rows}, key=lambda v: (v is None, v))]
    place = {lv: i for i, lv in enumerate(levels)}
    n = np.array([r["_n"] for r in rows], dtype=float)
    means = np.array([[r[f"m{i}"] for i in range(len(cols))] for r in rows]).reshape(len(rows), len(cols))
    center = (n[:, None] * means).sum(axis=0) / max(n.sum(), 1.0)
    p, k = len(levels), len(levels) + len(cols)
    out = [Moments(0.0, np.zeros(k), np.zeros((k, k))) for _ in range(folds)]
    for r, m, rows_here in zip(rows, means - center, n):
        f = out[r["_fold"]]
        own = [place[c, r[f"_c{i}"]] for i, c in enumerate(categorical)]
        f.n += rows_here
        f.s[own] += rows_here
        f.s[p:] += rows_here * m
        f.q[np.ix_(own, own)] += rows_here
        f.q[np.ix_(own, range(p, k))] += rows_here * m
        f.q[np.ix_(range(p, k), own)] += rows_here * m[:, None]
        v = np.array([[r[f"v{min(i, j)}_{max(i, j)}"] for j in range(len(cols))] for i in range(len(cols))])
        f.q[p:, p:] += rows_here * (v + np.outer(m, m))
    return out, levels, center


def _squares(held: Moments, b0: float, b: np.ndarray) -> float:
    """Sum of squared errors over the rows of ``held``."""
    w = np.append(-b, 1.0)
    return float(w @ held.q @ w - 2 * b0 * (w @ held.s) + held.n * b0 * b0)


def path(whole: Moments, penalties: Sequence[float], mix: float, kkt: float = KKT) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Intercept, coefficients and standardised coefficients at each penalty, from the largest down."""
    r, c, sd, mean = whole.standardized()
    unit = np.where(sd > 0, sd, 1.0)
    beta, out = np.zeros(len(c)), []
    for penalty in penalties:
        beta = descend(r, c, penalty, mix, beta, kkt)
        b = np.where(sd > 0, beta / unit, 0.0)
        out.append((float(mean[-1] - mean[:-1] @ b), b, beta.copy()))
    return out


def elastic_net(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = (), key: Sequence[str] = (), mix: float = 0.5,
                penalty: float | None = None, folds: int = 5, seed: int = 42) -> Net:
    """The net at ``penalty``, or at that of least squared error over ``folds`` folds dealt by a hash of ``key``."""
    if penalty is None and not key:
        raise ValueError("folds need a key")
    fold = F.floor(uniform(seed + 1, *key) * folds) if penalty is None else F.lit(0)
    held, levels, center = cells(df, target, numeric, categorical, fold, folds if penalty is None else 1)
    whole = held[0]
    for h in held[1:]:
        whole = whole + h
    if whole.n <= 0:
        raise ValueError("no complete rows to fit")
    errors: list[tuple[float, float]] = []
    penalties = [penalty]
    if penalty is None:
        top = float(np.abs(whole.standardized()[1]).max(initial=0.0)) / max(mix, 1e-3) or 1.0
        penalties = np.geomspace(top, top * SHORTEST, PENALTIES).tolist()
        total = np.zeros(len(penalties))
        for h in held:
            if h.n:
                total += [_squares(h, b0, b) for b0, b, _ in path(whole - h, penalties, mix, ROUGH)]
        errors = list(zip(penalties, np.sqrt(np.maximum(total, 0) / whole.n).tolist()))
        penalties = [penalties[int(total.argmin())]]
    b0, b, beta = path(whole, penalties, mix)[-1]
    p = len(levels)
    by_level: dict[str, dict] = {c: {} for c in categorical}
    for (c, v), x in zip(levels, b):
        by_level[c][v] = float(x)
    return Net(float(b0 + center[-1] - center[:-1] @ b[p:]), dict(zip(numeric, map(float, b[p:]))), by_level, float(penalties[-1]), errors, beta, whole)


def calibrated(resid: DataFrame, categorical: Sequence[str], numeric: Sequence[str], key: Sequence[str], test_share: float = 0.2, seed: int = 42, mix: float = 0.5) -> DataFrame:
    """Error of ``resid`` before and after the net's correction, on rows that it was not fitted on."""
    rows = checkpointed(resid)
    u = uniform(seed, *key)
    net = elastic_net(rows.where(u >= test_share), "resid", numeric, categorical, key, mix, seed=seed)
    e = F.col("resid") - F.col("_fitted")
    return net.effects(rows.where(u < test_share), "_fitted").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("resid") * F.col("resid"))).alias("rmse_before"),
                                                                  F.sqrt(F.avg(e * e)).alias("rmse_after"))
