"""Exact LOWESS of all rows from power moments (OLS11).

Every row gets the local linear fit over its ``k`` nearest rows in ``x``, with
tricube weights ``(1 - (d / h)^3)^3`` (no robustness step).  On either side of
the centre the weight is a polynomial of degree nine, so all five sums of a fit
follow from sums of ``x^a`` (a to 11) and ``x^a y`` (a to 10) over stretches of
the sorted rows.  Moments belong to blocks and are taken about the block's own
centre; a block that lies inside a window is at most as wide as the window, so
shifting its moments to the window's centre loses no digits, however far the
data are from zero.

1. Rows are numbered in order of ``x`` over range partitions.
2. The window of row ``i`` begins at the number of ``l`` with
   ``x[l] + x[l + k] < 2 x[i]``: a merge of two sorted tables, done as one more
   numbering of their union.
3. Blocks of ``size`` consecutive rows give one row of moments each; a binary
   tree over them is sent to the tasks (26 numbers a block).
4. Rows whose own block and whose window's first block are the same are one
   unit of work: it gets the rows of its own block and of those where its
   windows begin and end, and binary trees over them.  There are at most two units a block.

A fit costs some ``log n`` blocks; the memory of a unit is five blocks of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .rank import global_index

_X, _Y = 12, 11  #: powers of x, and of x times y
#: most blocks while rows are few, and bounds of a block's rows
BLOCKS, LEAST, MOST = 2048, 1024, 65536
#: fits that a pass takes at once
_ROWS = 1 << 12


def _shifted(moments: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Moments about ``centre - by`` from moments about the centre, row by row."""
    return _shift(moments.T.copy(), by).T


def _shift(moments: np.ndarray, by: np.ndarray) -> np.ndarray:
    """:func:`_shifted` in place for moments a line: Pascal's triangle, a line of it a step."""
    for j in range(1, len(moments)):
        moments[j:] += moments[j - 1:-1] * by
    return moments


@dataclass
class _Level:
    """Blocks of a level: centre, moments of x and of x with y."""

    c: np.ndarray
    m: np.ndarray
    n: np.ndarray
    #: whether a block has more than its centre
    spread: bool = True

    def __post_init__(self) -> None:
        self.mt, self.nt = np.ascontiguousarray(self.m.T), np.ascontiguousarray(self.n.T)

    def paired(self) -> _Level:
        """The level above: neighbours two by two (a last single one stays)."""
        odd = len(self.c) % 2
        a, b = slice(0, len(self.c) - odd, 2), slice(1, None, 2)
        c = (self.c[a] + self.c[b]) / 2
        m = _shifted(self.m[a], self.c[a] - c) + _shifted(self.m[b], self.c[b] - c)
        n = _shifted(self.n[a], self.c[a] - c) + _shifted(self.n[b], self.c[b] - c)
        if odd:
            c, m, n = np.append(c, self.c[-1]), np.vstack([m, self.m[-1:]]), np.vstack([n, self.n[-1:]])
        return _Level(c, m, n)


def _tree(leaves: _Level) -> list[_Level]:
    out = [leaves]
    while len(out[-1].c) > 1:
        out.append(out[-1].paired())
    return out


def _rows_as_blocks(x: np.ndarray, y: np.ndarray) -> _Level:
    m, n = np.zeros((len(x), _X)), np.zeros((len(x), _Y))
    m[:, 0], n[:, 0] = 1.0, y
    return _Level(np.asarray(x, dtype=float), m, n, False)


def _powers(v: np.ndarray, n: int) -> np.ndarray:
    """``v`` to the power of 0 to ``n - 1``, a power a line."""
    out = np.empty((n, len(v)))
    out[0], out[1:] = 1.0, v
    return np.multiply.accumulate(out, axis=0, out=out)


def _add(sums: np.ndarray, level: _Level, block: np.ndarray, row: np.ndarray, x0: np.ndarray, h: np.ndarray, side: int) -> None:
    """Add a block's weighted sums of 1, d, d^2, y, d y (d in units of h) to each row's."""
    for lo in range(0, len(row), _ROWS):
        b, r = block[lo:lo + _ROWS], row[lo:lo + _ROWS]
        inverse = 1.0 / h[r]
        by = (level.c[b] - x0[r]) * inverse
        if level.spread:
            unit = _powers(inverse, _X)
            m = _shift(level.mt.take(b, axis=1) * unit, by)
            n = _shift(level.nt.take(b, axis=1) * unit[:_Y], by)
        else:
            m = _powers(by, _X)
            n = m[:_Y] * level.nt[0].take(b)
            m *= level.mt[0].take(b)
        for k, (d, p) in enumerate(((m, 0), (m, 1), (m, 2), (n, 0), (n, 1))):
            sums[r, k] += d[p] - side * 3 * d[p + 3] + 3 * d[p + 6] - side * d[p + 9]  # a row occurs once


def _add_range(sums: np.ndarray, tree: list[_Level], lo: np.ndarray, hi: np.ndarray, x0: np.ndarray, h: np.ndarray, side: int) -> None:
    """Add the blocks ``lo[i]:hi[i]`` of the lowest level to row ``i``, by the largest blocks that fit."""
    lo, hi = lo.copy(), np.maximum(hi, lo)
    for level in tree:
        first = np.flatnonzero((lo < hi) & (lo % 2 == 1))
        _add(sums, level, lo[first], first, x0, h, side)
        lo[first] += 1
        last = np.flatnonzero((lo < hi) & (hi % 2 == 1))
        _add(sums, level, hi[last] - 1, last, x0, h, side)
        hi[last] -= 1
        lo, hi = lo // 2, hi // 2


def _fits(points: pa.Table, zone: pa.Table, k: int, size: int, coarse: list[_Level]) -> pa.Table:
    """Fitted values of one unit's rows; null where all neighbours lie at the row's own x."""
    at, x0, l = (points[c].to_numpy() for c in ("idx", "x", "l"))
    zone = zone.sort_by("z_idx")
    z_at, z_x, z_y = (zone[c].to_numpy() for c in ("z_idx", "z_x", "z_y"))
    last = l + k - 1
    value = lambda place: z_x[np.searchsorted(z_at, place)]
    h = np.maximum(x0 - value(l), value(last) - x0)
    used = np.flatnonzero(h > 0)
    fitted = np.full(len(at), np.nan)
    if len(used):
        at, x0, l, last, h = at[used], x0[used], l[used], last[used], h[used]
        sums = np.zeros((len(used), 5))
        trees: dict[int, list[_Level]] = {}
        for b in np.unique(np.concatenate([at, l, last]) // size).tolist():
            rows = slice(*np.searchsorted(z_at, [b * size, (b + 1) * size]))
            trees[b] = _tree(_rows_as_blocks(z_x[rows], z_y[rows]))
        for lo, hi, side in ((l, at, -1), (at, last + 1, 1)):  # before the row, and from it on
            first, final = lo // size, hi // size
            for b, tree in trees.items():  # the parts of blocks at both ends
                for here, begin, end in ((first == b, lo - b * size, np.minimum(hi - b * size, size)),
                                         ((final == b) & (first != b), np.zeros_like(lo), hi - b * size)):
                    rows = np.flatnonzero(here)
                    if len(rows):
                        part = np.zeros((len(rows), 5))
                        _add_range(part, tree, begin[rows], end[rows], x0[rows], h[rows], side)
                        sums[rows] += part
            _add_range(sums, coarse, first + 1, final, x0, h, side)
        w, wd, wdd, wy, wdy = sums.T
        spread = w * wdd - wd * wd
        flat = spread <= 1e-12 * w * wdd
        fitted[used] = np.where(flat, wy / w, (wdd * wy - wd * wdy) / np.where(flat, 1.0, spread))
    return pa.table({"idx": points["idx"], "fitted": pa.array(fitted, mask=np.isnan(fitted))})


def _block_moments(block: pa.Table) -> pa.Table:
    leaves = _rows_as_blocks(block["x"].to_numpy(), block["y"].to_numpy())
    top = _tree(leaves)[-1]
    return pa.table({"block": block["block"].slice(0, 1), "c": pa.array(top.c), "m": pa.array(top.m.tolist()), "n": pa.array(top.n.tolist())})


def lowess(df: DataFrame, x: str, y: str, frac: float = 2.0 / 3.0, keep: tuple[str, ...] = (), size: int | None = None) -> DataFrame:
    """``keep`` columns, ``x``, ``y`` and ``fitted`` of every row with both numbers.

    ``floor(frac * n)`` rows (two at least) make a window.  Where a whole window
    lies at one x the fit is the mean of all rows there.  An empty table gives
    an empty result.
    """
    spark = df.sparkSession
    source = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    rows = checkpointed(global_index(source.where("x is not null and y is not null"), ["x"]))
    n = rows.count()
    k = min(n, max(2, int(frac * n + 1e-10)))
    size = size or min(MOST, max(LEAST, -(-n // BLOCKS)))
    points = rows.select("idx", "x")
    ends = points.select((F.col("idx") - k).alias("e_idx"), F.col("x").alias("e_x"))
    begins = points.join(ends, F.col("idx") == F.col("e_idx")).select((F.col("x") + F.col("e_x")).alias("v"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("idx"), F.lit(None).cast("double").alias("x"))
    merged = points.select((2 * F.col("x")).alias("v"), F.lit(0).alias("kind"), "idx", "x").unionAll(begins)
    placed = global_index(merged, ["v", "kind", "idx"], name="place").where("kind = 0")
    units = checkpointed(placed.select("idx", "x", (F.col("place") - F.col("idx")).alias("l"))
                        .withColumn("own", F.floor(F.col("idx") / size)).withColumn("first", F.floor(F.col("l") / size)))
    end = lambda more: F.floor((F.col("first") * size + k - 1 + more) / size)
    zones = (units.select("own", "first").distinct()  # two a block at most
             .select(F.col("own").alias("z_own"), F.col("first").alias("z_first"),
                     F.explode(F.array_distinct(F.array("own", "first", end(0), end(size - 1)))).alias("z_block")))
    blocks = rows.select("idx", "x", "y", F.floor(F.col("idx") / size).alias("block"))
    found = blocks.groupBy("block").applyInArrow(_block_moments, "block long, c double, m array<double>, n array<double>").toArrow().sort_by("block")
    leaves = _Level(found["c"].to_numpy(), np.array(found["m"].to_pylist()).reshape(-1, _X), np.array(found["n"].to_pylist()).reshape(-1, _Y))
    coarse = spark.sparkContext.broadcast(_tree(leaves))  # 26 numbers a block
    zone_rows = blocks.join(zones, F.col("block") == F.col("z_block")).select(
        "z_own", "z_first", F.col("idx").alias("z_idx"), F.col("x").alias("z_x"), F.col("y").alias("z_y"))
    fits = units.groupBy("own", "first").cogroup(zone_rows.groupBy("z_own", "z_first")).applyInArrow(
        lambda points, zone: _fits(points, zone, k, size, coarse.value), "idx long, fitted double")
    means = rows.groupBy(F.col("x").alias("m_x")).agg(F.avg("y").alias("mean"))
    fits = checkpointed(fits.select(F.col("idx").alias("f_idx"), "fitted"))
    joined = rows.join(fits, F.col("idx") == F.col("f_idx"))
    # a window at one x: ``k`` rows or more share it, so there are at most n / k such values
    flat = joined.where("fitted is null").join(means, F.col("x") == F.col("m_x")).withColumn("fitted", F.col("mean"))
    names = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    out = [*names, F.col("x").alias(x), F.col("y").alias(y), "fitted"]
    return joined.where("fitted is not null").select(*out).unionAll(flat.select(*out))
