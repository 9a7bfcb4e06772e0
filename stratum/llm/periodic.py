"""Periodic runs of words: Lyndon arrays from the grouping phase of a suffix sorter.

A run is a maximal stretch of words with smallest period ``q`` whose length is
at least ``min_length`` and ``min_exponent`` periods.  Every run has a Lyndon
root, under the order of the words or under its reverse, that is the longest
Lyndon word where it begins.  ``lyndon_array`` gets the lengths of all these
words from the first phase of Baier's suffix sorter: suffixes are grouped by
their first word, groups are taken from the highest down, and the nearest
earlier suffix of a lower group grows by the group's context once for each
suffix that points at it.  When a group's turn comes its context is the longest
Lyndon word of its members.  ``runs_of`` takes both arrays and extends each
root to both sides by longest common extensions over hashed blocks of
1, 2, 4, ... words.

The grouping is sequential, so only words that can lie in a run get there: in a
run of at least ``min_length`` words and ``min_exponent`` periods every word
lies in a sequence of ``min_length - min_length // min_exponent`` words that
the text holds twice.  Stretches of such words are found with numpy passes; the
rest of a text holds no part of a run, so a run of a stretch is one of the text.

Words are compared by 64-bit hashes (two different words of one text agree with
a chance of about 1e-11 in a text of 20,000 words).  A task's memory is linear
in the longest text, and n log n in its longest repeated stretch (about 200 MB
for a million words).

Defined cases: null, empty and blank texts have no words, no runs and an empty
collapsed text; every row is judged for itself, whatever its id, so repeated
rows and null ids are kept; an empty table gives an empty result; only the
columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import words as W

MIN_LENGTH = 24
MIN_EXPONENT = 3
_A, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)


def lyndon_array(x: list[int], letters: int) -> list[int]:
    """Length of the longest Lyndon word at each place of ``x``, a list of letters ``0 .. letters - 1``."""
    n = len(x)
    group = list(x)
    members: list[list[int]] = [[] for _ in range(letters)]
    for i, g in enumerate(x):
        members[g].append(i)
    context = [1] * letters
    below = list(range(-1, letters - 1))
    above = list(range(1, letters + 1))
    above[-1] = -1
    lower = list(range(n + 1))  # lower[i + 1]: towards the nearest place up to i whose group has not had its turn, plus 1
    out = [1] * n
    g = letters - 1
    while g >= 0:
        c = context[g]
        own = [i for i in members[g] if group[i] == g]
        for i in own:
            out[i] = c
            lower[i + 1] = i
        points: dict[int, int] = {}
        for i in own:
            while lower[i] != i:
                lower[i] = i = lower[lower[i]]
            if i:
                points[i] = points.get(i, 0) + 1
        fresh: dict[tuple[int, int], int] = {}
        ordered = points.items() if len(points) < 2 else sorted(points.items(), key=lambda p: -p[1])
        for j, times in ordered:  # most pointers first: their group ends highest above the old one
            old = group[j - 1]
            new = fresh.get((old, times))
            if new is None:
                new = fresh[old, times] = len(context)
                context.append(context[old] + times * c)
                members.append([])
                up = above[old]
                above.append(up)
                below.append(old)
                above[old] = new
                below[up] = new  # ``up`` exists: the group whose turn it is stands above
            members[new].append(j - 1)
            group[j - 1] = new
        members[g] = []
        g = below[g]
    return out


def _blocks(x: np.ndarray) -> list[np.ndarray]:
    """Hashes of the 1, 2, 4, ... letters from each place on."""
    out, size = [W.mix(x.astype(np.uint64) * _A + _C)], 1
    while 2 * size <= len(x):
        last = out[-1]
        with np.errstate(over="ignore"):
            out.append(W.mix(last[:-size] * _A + (last[size:] ^ _C)))
        size *= 2
    return out


def _extension(blocks: list[np.ndarray], i: np.ndarray, p: np.ndarray, back: bool) -> np.ndarray:
    """How many letters from ``i`` on (``back``: before ``i``) equal those ``p`` further."""
    n, out = len(blocks[0]), np.zeros(len(i), dtype=np.int64)
    for k in range(len(blocks) - 1, -1, -1):
        size = 1 << k
        at = i - out - size if back else i + out
        fits = np.flatnonzero((at >= 0) & (at + p + size <= n))
        here = at[fits]
        out[fits[blocks[k][here] == blocks[k][here + p[fits]]]] += size
    return out


def runs_of(x: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """``(start, length, period)`` rows of all runs of ``x`` in order of start and period."""
    known, ranks = np.unique(x, return_inverse=True)
    found = np.zeros((0, 3), dtype=np.int64)
    blocks = _blocks(ranks)
    at = np.arange(len(x))
    for order in (ranks, len(known) - 1 - ranks):
        p = np.array(lyndon_array(order.tolist(), len(known)), dtype=np.int64)
        i = np.flatnonzero((at + p < len(x)) & (min_exponent * p <= len(x)))
        i = i[ranks[i] == ranks[i + p[i]]]  # some root of a run is followed by another period of it
        p = p[i]
        before, after = _extension(blocks, i, p, True), _extension(blocks, i, p, False)
        length = before + p + after
        long_enough = length >= np.maximum(min_length, min_exponent * p)
        found = np.concatenate([found, np.stack([i - before, length, p], axis=1)[long_enough]])
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _twice(w: W.Words, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of words that lie in a sequence of ``size`` words that their text holds twice."""
    if len(w.hash) < size:
        return
    h, width = w.hash, 1
    with np.errstate(over="ignore"):
        while width < size:
            step = min(width, size - width)
            h = W.mix(h[:-step] * _A + (h[step:] ^ _C))
            width += step
        rows = w.row_of()
        at = np.flatnonzero(rows[:len(h)] == rows[size - 1:])
        keys = W.mix(h[at] + W.mix(rows[at].astype(np.uint64) * _A))
    order = np.argsort(keys)
    equal = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    if not len(equal):
        return
    steps = np.zeros(len(w.hash) + 1, dtype=np.int64)
    twice = np.unique(np.concatenate([at[order[equal]], at[order[equal + 1]]]))
    steps[twice] += 1
    np.add.at(steps, twice + size, -1)
    inside = np.concatenate([[False], np.cumsum(steps)[:-1] > 0, [False]])
    edge = inside[1:] != inside[:-1]
    edge[w.first[(w.first > 0) & (w.first < len(w.hash))]] |= True  # texts are apart
    places = np.flatnonzero(edge)
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        if inside[a + 1]:
            yield a, b


def _runs_by_row(w: W.Words, min_length: int, min_exponent: int) -> dict[int, np.ndarray]:
    """The runs of each row of a slice that has any; starts count words of the row."""
    found: dict[int, list[np.ndarray]] = {}
    for a, b in _twice(w, max(1, min_length - min_length // min_exponent)):
        if b - a >= min_length:
            runs = runs_of(w.hash[a:b], min_length, min_exponent)
            if len(runs):
                row = int(np.searchsorted(w.first, a, side="right")) - 1
                runs[:, 0] += a - w.first[row]
                found.setdefault(row, []).append(runs)
    return {row: np.concatenate(runs) for row, runs in found.items()}


def _collapsed(text: bytes, runs: np.ndarray | None) -> bytes:
    """The words one space apart, of every run only its first period (words that another run drops are dropped)."""
    words = text.split()  # of bytes: at ASCII white space only
    if runs is not None:
        steps = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
        np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def detect(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", min_length: int = MIN_LENGTH,
           min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``keep`` columns, ``runs`` (array of start, length, period in words) and the ``collapsed`` text of every row.

    ``min_exponent`` is a whole number of 2 or more.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(f"`{text}`").alias("t"))
    run_type = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
    schema = StructType([*(source.schema[n] for n in names), StructField("runs", ArrayType(run_type)),
                         StructField("collapsed", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names))
            for lo, hi, w in W.slices(texts):
                found = _runs_by_row(w, min_length, min_exponent)
                raw = texts.slice(lo, hi - lo).cast(pa.binary()).to_pylist()
                flat = np.concatenate([found[r] for r in sorted(found)]) if found else np.zeros((0, 3), np.int64)
                sizes = np.array([len(found.get(r, ())) for r in range(hi - lo)])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in flat.T], fields=list(_RUN)))
                words = pa.array([_collapsed(t or b"", found.get(r)) for r, t in enumerate(raw)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:-1]), lists, words],
                                                 names=[*names, "runs", "collapsed"])

    return source.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))
