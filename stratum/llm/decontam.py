"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment.

The benchmark is the stated query set.  It is taken in blocks of a bounded
number of words; each block is broadcast and meets every document.  A first
pass counts the block's close pairs (two words with at most one between them)
in the whole corpus; a second pass finds the seeds in every document and aligns
the item with the words around each hit by local alignment of words (match 2,
mismatch -1, gap -1), so insertions, deletions and replaced words lower the
score instead of hiding the copy.

Seeds lose nothing.  Two matches of an alignment that follow each other are a
close pair of both texts, or at least two words were edited between them: an
alignment of score S has (S - 2) / 2 or more close pairs in a row.  An item's
most common pairs are left out only as long as fewer than that many of them fit
one after the other, so every alignment that is good enough holds a seed,
however the copy was edited, and the window around a seed is as wide as such an
alignment can be.

A pair is reported when its score is at least ``ratio`` of that of a perfect
copy, or of ``enough`` words for long items, and never below that of ``floor``
words: items of up to ``floor`` words are found as exact word sequences only.
Words are folded: case and ASCII punctuation do not matter.  In scripts that
are written without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) every
character is a word, and ``floor`` is twice as many for items of such words.

Defined cases: null and blank texts match nothing; items under ``min_words``
words match nothing (1: every item with a word is looked for); repeated documents and items are
reported each; a null id stays null; only id and text columns are read; empty
tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import words as W
from .store import packed, unpacked, written

MIN_WORDS = 1
RATIO = 0.5
ENOUGH = 50
#: words that a copy must match whatever the ratio; twice as many characters
FLOOR = 7
#: characters of scripts without spaces between words, and the marks between them
UNSPACED = "\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3031-\u3035\u3041-\u30FA\u30FC-\u30FF\u31F0-\u31FF" \
           "\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9D\U00020000-\U0003FFFF"
_MARKS = "\u3000-\u3004\u3008-\u3020\u3030\u30FB\uFF01-\uFF0F\uFF1A-\uFF20\uFF3B-\uFF40\uFF5B-\uFF65"
_APART = re.compile(f"([{UNSPACED}])|[{_MARKS}]")
#: first UTF-8 bytes of these characters
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True
#: words of benchmark text in a broadcast block: about 8 bytes each, some MB with the seeds
BLOCK_WORDS = 200_000
MATCH, MISMATCH, GAP = 2, -1, -1
_SHIFT = 32


class _Lookup:
    """Membership of 64-bit hashes in a small sorted set, behind a bitmap."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the members among ``hashes`` and their places in ``keys``."""
        at = np.flatnonzero(self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        place = np.searchsorted(self.keys, hashes[at])
        ok = place < len(self.keys)
        ok[ok] = self.keys[place[ok]] == hashes[at][ok]
        return at[ok], place[ok]


def _slices(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, W.Words]]:
    """Folded words by runs of rows; every character of a script without spaces is a word."""
    for lo, hi, w in W.slices(texts, W.FOLDED, True, limit):
        if not _LEADS[w.data].any():
            yield lo, hi, w
            continue
        apart = pa.array([_APART.sub(r" \1 ", t or "") for t in texts.slice(lo, hi - lo).to_pylist()], pa.string())
        for a, b, v in W.slices(apart, W.FOLDED, True, limit):
            yield lo + a, lo + b, v


def _pairs(w: W.Words, single: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first positions of the close pairs (neighbours, or with one word between); before them, with ``single``, of the words."""
    row_end = np.repeat(w.first[1:], w.counts())
    own, other = W.mix(w.hash), W.mix(w.hash ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    out, places = ([own], [np.arange(len(own))]) if single else ([], [])
    for gap in (1, 2):
        at = np.flatnonzero(np.arange(len(row_end)) + gap < row_end)
        with np.errstate(over="ignore"):
            out.append(own[at] + other[at + gap])
        places.append(at)
    return np.concatenate(out), np.concatenate(places)


def corpus_counts(docs: DataFrame, pairs: np.ndarray, text: str = "text", single: bool = False) -> np.ndarray:
    """How often each of the sorted distinct ``pairs`` occurs in all texts."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(_Lookup(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = known.value
        total = np.zeros(len(look.keys), dtype=np.int64)
        for batch in batches:
            for _, _, w in _slices(batch.column(0)):
                total += np.bincount(look.find(_pairs(w, single)[0])[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    rows = (docs.select(F.lower(text).alias("t")).mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).toArrow())  # at most a row a pair of the block
    out = np.zeros(len(known.value.keys), dtype=np.int64)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out


def _needed(length: np.ndarray, unspaced: np.ndarray, ratio: float, enough: int, floor: int) -> np.ndarray:
    """The score that makes an alignment a copy, by item; ``unspaced`` of its words are single characters."""
    least = floor * (1 + unspaced / np.maximum(length, 1))
    return MATCH * np.maximum(np.minimum(ratio * length, enough), np.minimum(least, length))


def _longest_chain(near: list[bool], far: list[bool]) -> int:
    """How many pairs fit one after the other: ``near[i]`` is words i and i + 1, ``far[i]`` words i and i + 2."""
    before, last = 0, 0
    for i, adjacent in enumerate(near):
        here = last + 1 if adjacent else last
        if i and far[i - 1] and before + 1 > here:
            here = before + 1
        before, last = last, here
    return last


def rare_seeds(items: W.Words, need: np.ndarray, docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions (in ``items``) of the seeds: the rarest pairs, so many that every alignment of score ``need`` holds one.

    An item of one word is its own seed.
    """
    hashes, at = _pairs(items, True)
    single = np.arange(len(at)) < len(items.hash)
    far = np.arange(len(at)) >= len(at) - int(np.maximum(items.counts() - 2, 0).sum())
    row = items.row_of()[at]
    used = ~single | (items.counts()[row] == 1)
    hashes, at, far, row = hashes[used], at[used], far[used], row[used]
    known = np.unique(hashes)
    n = corpus_counts(docs, known, text, bool((items.counts() == 1).any()))[np.searchsorted(known, hashes)]
    chosen = np.zeros(len(hashes), dtype=bool)
    order = np.lexsort((hashes, n, row))
    edges = np.searchsorted(row[order], np.arange(items.rows + 1))
    for r, length in enumerate(items.counts().tolist()):
        own = order[edges[r]:edges[r + 1]]  # rarest first
        if length == 1:
            chosen[own] = True
            continue
        place = (at[own] - items.first[r]).tolist()
        skips = far[own].tolist()
        links = max(1, int(np.ceil((need[r] - MATCH) / 2)))
        lo, hi = 0, len(own)
        while lo < hi:  # the fewest seeds that leave no chain of ``links`` other pairs
            mid = (lo + hi) // 2
            left = [False] * (length - 1), [False] * (length - 1)
            for p, s in zip(place[mid:], skips[mid:]):
                left[s][p] = True
            if _longest_chain(*left) < links:
                hi = mid
            else:
                lo = mid + 1
        chosen[own[:lo]] = True
    chosen &= n > 0  # a pair that no document holds finds nothing
    return hashes[chosen], at[chosen]


def align(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of the word hashes ``item`` with each row of ``windows``: score, from, to (words).

    A cell holds its score in the high bits and where its alignment began in the
    low bits, so that one maximum carries both.
    """
    n, width = windows.shape
    unit = np.int64(1) << _SHIFT
    column = np.arange(width, dtype=np.int64)
    fresh = column + 1  # score 0: the next alignment may begin one word on
    gaps = column * (-GAP * unit)
    before = np.broadcast_to(fresh, (n, width)).copy()
    best = np.zeros(n, dtype=np.int64)
    stop = np.zeros(n, dtype=np.int64)
    row = np.arange(n)
    diagonal = np.empty_like(before)
    for word in item:
        diagonal[:, 1:] = before[:, :-1]
        diagonal[:, 0] = 0
        diagonal += np.where(windows == word, MATCH * unit, MISMATCH * unit)
        now = np.maximum(np.maximum(diagonal, before + GAP * unit), fresh)
        now = np.maximum.accumulate(now + gaps, axis=1) - gaps
        now = np.maximum(now, fresh)
        at = (now >> _SHIFT).argmax(axis=1)
        found = now[row, at]
        better = (found >> _SHIFT) > (best >> _SHIFT)
        best = np.where(better, found, best)
        stop = np.where(better, at + 1, stop)
        before = now
    return best >> _SHIFT, best & (unit - 1), stop


def _matches(w: W.Words, look: _Lookup, seed_at: list[np.ndarray], item_of: np.ndarray, items: W.Words,
             needed: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Best alignment of each (row, item) of a slice that is good enough: rows, item, score, from, to."""
    hashes, at = _pairs(w, bool((items.counts() == 1).any()))
    hit, seed = look.find(hashes)
    if not len(hit):
        return
    times = np.array([len(x) for x in seed_at])[seed]
    p = np.repeat(at[hit], times)
    q = np.concatenate([seed_at[s] for s in seed.tolist()])
    item = item_of[q]
    doc = w.row_of()[p]
    length = items.counts()[item]
    pad = np.maximum(8, length // 4)
    lane = (p - w.first[doc] - (q - items.first[item])) // pad
    order = np.lexsort((lane, doc, item))
    item, doc, lane = item[order], doc[order], lane[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (lane[1:] != lane[:-1])
    item, part_all = item[fresh], np.stack([doc[fresh], lane[fresh]])
    edges = np.concatenate([[0], np.flatnonzero(item[1:] != item[:-1]) + 1, [len(item)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        i = int(item[a])
        own = items.hash[items.first[i]:items.first[i + 1]]
        part = part_all[:, a:b]
        need = needed[i]
        pad_i = max(8, len(own) // 4)
        more = int(MATCH * len(own) - need)  # words that a copy may add
        width = len(own) + pad_i + 2 * more
        step = max(1, (1 << 20) // width)
        rows, scores, starts, stops = [], [], [], []
        for lo in range(0, part.shape[1], step):
            d, lane_ = part[0, lo:lo + step], part[1, lo:lo + step]
            begin = w.first[d] + lane_ * pad_i - more
            place = begin[:, None] + np.arange(width)
            inside = (place >= w.first[d][:, None]) & (place < w.first[d + 1][:, None])
            window = np.where(inside, w.hash[np.clip(place, 0, len(w.hash) - 1)], np.uint64(0))
            score, start, stop = align(own, window)
            ok = score >= need
            rows.append(d[ok])
            scores.append(score[ok])
            starts.append((begin - w.first[d] + start)[ok])
            stops.append((begin - w.first[d] + stop)[ok])
        rows, scores, starts, stops = map(np.concatenate, (rows, scores, starts, stops))
        if len(rows):
            order = np.lexsort((starts, -scores, rows))
            first = order[np.append(True, rows[order][1:] != rows[order][:-1])]
            yield rows[first], i, scores[first], starts[first], stops[first]


def _blocks(benchmark: DataFrame, item_key: str, item_text: str, block_words: int) -> Iterator[pa.Table]:
    """The items by blocks of about ``block_words`` words; rows are dealt by their number, so repeated ones spread."""
    items = written(benchmark.select(F.col(item_key).alias("i"), F.lower(item_text).alias("t"), F.monotonically_increasing_id().alias("u")),
                    "decontam-items")
    total = items.agg(F.sum(F.regexp_count("t", F.lit(f"[{UNSPACED}]|[\\p{{Alnum}}[^\\x00-\\x7F]&&[^{UNSPACED}]]+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for b in range(blocks):
        yield items.where(F.pmod(F.xxhash64("u"), F.lit(blocks)) == b).select("i", "t").toArrow()


@dataclass
class _Sent:
    """What a task needs to find a block's items."""

    look: _Lookup
    seed_at: list[np.ndarray]
    items: W.Words
    ids: pa.Array
    needed: np.ndarray

    def matches(self, w: W.Words) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]:
        return _matches(w, self.look, self.seed_at, self.items.row_of(), self.items, self.needed)


def _prepared(docs: DataFrame, block: pa.Table, text: str, ratio: float, enough: int, min_words: int, floor: int) -> Broadcast | None:
    """The block's seeds, counted over all of ``docs``; None if no item is long enough."""
    spark = docs.sparkSession
    texts = block["t"].combine_chunks() if block.num_rows else pa.array([], pa.string())
    parsed = [(lo, w) for lo, _, w in _slices(texts, limit=1 << 40)]
    long_enough = np.flatnonzero(parsed[0][1].counts() >= min_words) if parsed else np.zeros(0, np.int64)
    if not len(long_enough):
        return None
    ids = block["i"].combine_chunks().take(pa.array(long_enough))
    texts = texts.take(pa.array(long_enough))
    _, _, items = next(_slices(texts, limit=1 << 40))
    unspaced = np.array([len(re.findall(f"[{UNSPACED}]", t)) for t in texts.to_pylist()])
    needed = _needed(items.counts(), unspaced, ratio, enough, floor)
    hashes, places = rare_seeds(items, needed, docs, text)
    look = _Lookup(hashes)
    order = np.argsort(np.searchsorted(look.keys, hashes), kind="stable")
    edges = np.searchsorted(np.searchsorted(look.keys, hashes)[order], np.arange(len(look.keys) + 1))
    seed_at = [places[order[lo:hi]] for lo, hi in zip(edges[:-1], edges[1:])]
    items.data = np.zeros(0, np.uint8)  # the text itself is not needed any more
    return spark.sparkContext.broadcast(_Sent(look, seed_at, items, ids, needed))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                 item_text: str = "text", ratio: float = RATIO, enough: int = ENOUGH, block_words: int = BLOCK_WORDS,
                 min_words: int = MIN_WORDS, floor: int = FLOOR) -> DataFrame:
    """``(key, item_key, score, from_word, to_word)``: documents with a copy of a benchmark item.

    ``score`` is the alignment score over that of a perfect copy; the words are
    counted in the folded text, ``to_word`` exclusive.
    """
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    schema = f"k {kinds[0]}, i {kinds[1]}, score double, from_word long, to_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for n, block in enumerate(_blocks(benchmark, item_key, item_text, block_words)):
        sent = _prepared(docs, block, text, ratio, enough, min_words, floor)
        if sent is not None:
            part = docs.select(F.col(key).alias("k"), F.lower(text).alias("t")).mapInArrow(_found(sent, enough / ratio), schema)
            out = part if n == 0 else out.unionAll(part)
    return out.select(F.col("k").alias(key), F.col("i").alias(item_key), "score", "from_word", "to_word")


def _found(sent: Broadcast, longest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for lo, _, w in _slices(batch.column(1)):
                for rows, i, score, start, stop in known.matches(w):
                    full = MATCH * min(known.items.first[i + 1] - known.items.first[i], longest)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows + lo)), known.ids.take(pa.array(np.full(len(rows), i))),
                         pa.array(np.minimum(1.0, score / full)), pa.array(start), pa.array(stop)],
                        names=["k", "i", "score", "from_word", "to_word"])

    return run


def _kept(sent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for lo, _, w in _slices(batch.column(1)):
                for rows, *_ in known.matches(w):
                    keep[rows + lo] = False
            yield pa.RecordBatch.from_arrays(batch.columns[:1], names=["row"]).filter(pa.array(keep))

    return run


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", ratio: float = RATIO, enough: int = ENOUGH, block_words: int = BLOCK_WORDS,
          min_words: int = MIN_WORDS, floor: int = FLOOR) -> DataFrame:
    """The rows of ``docs`` whose text holds no copy of a benchmark item; each row is judged by its own text, whatever its id."""
    out = docs
    for block in _blocks(benchmark, item_key, item_text, block_words):
        sent = _prepared(docs, block, text, ratio, enough, min_words, floor)
        if sent is not None:
            rows = packed(out, t=F.lower(text))
            out = unpacked(rows.mapInArrow(_kept(sent), StructType([rows.schema["row"]])))
    return out
