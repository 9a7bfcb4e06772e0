"""License scan: MinHash bands over overlapping text windows, then exact containment.

Texts are cut into windows of ``WINDOW`` words, every ``STRIDE`` words; templates
into pieces of ``WINDOW`` words at every word.  A window whose MinHash band
equals a piece's band retrieves the template.  The number of bands follows from
the least similarity that a true match leaves in some window and from the
chance of missing it that is allowed (:func:`bands_for`).  A retrieved template
is verified where it was found: the share of its distinct five-word shingles
that the words around the window hold must reach ``CONTAINMENT``.

Why some window is similar enough: with at least 80 % of a template's shingles
present, a notice of up to 8 words has none missing and lies in one window or
half in each of two (similarity 1/4 or more); a longer one has a run of two
shingles present, which gives one window 2 of them or two windows 1 each
(similarity 2/6, or 1/7 twice).

With ``best``, templates compete for a place: a find goes if a find of another
template overlaps it that holds more of its own shingles (then the larger share,
then the earlier name), so a version or variant does not come out under its
sibling's name, nor a short line inside the header that holds it.

Templates are the stated query set: they are sent around in blocks of a bounded
number of words, and every block meets every document.  Words are folded, so
case and punctuation do not matter.

Defined cases: null and blank texts match nothing; a text or template shorter
than five words has no shingle and matches nothing; repeated documents are
reported each; a template given twice under one name counts once; only id and
text are read; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .license_texts import LICENSES
from .store import written

WINDOW, STRIDE = 8, 4
CONTAINMENT = 0.8
LEAST_SIMILARITY = 0.25
MISS = 1e-5
#: words of templates in a broadcast block: about 0.5 KB of bands each
BLOCK_WORDS = 20_000
_BITS = 1 << 16


def bands_for(similarity: float, miss: float, rows: int = 1) -> int:
    """Fewest bands of ``rows`` values that miss a pair of that similarity with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-similarity ** rows))


def stretch(words: int) -> int:
    """Shingle positions within which a template of that many words is looked for: its own, and room for added words."""
    return words - W.SHINGLE + 1 + 3 + words // 10


BANDS = bands_for(LEAST_SIMILARITY, MISS)


def _window_hashes(w: W.Words, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """MinHash values of the windows, their rows and first words; and the shingles of all positions.

    A row's last window may be shorter; positions without a shingle hold the maximum.
    """
    shingles, valid = W.ngrams(w, W.SHINGLE)
    n = w.counts()
    windows = np.where(n >= W.SHINGLE, np.maximum(1, -(-(n - W.SHINGLE + 1) // stride)), 0)
    row = np.repeat(np.arange(w.rows), windows)
    first = np.concatenate([[0], np.cumsum(windows)])
    begin = w.first[row] + (np.arange(len(row)) - first[row]) * stride
    place = begin[:, None] + np.arange(WINDOW - W.SHINGLE + 1)
    inside = place <= (w.first[row + 1] - W.SHINGLE)[:, None]
    flat = np.append(shingles, np.uint64(0))[np.where(inside, place, len(shingles))]
    used = np.flatnonzero(inside.any(axis=1))
    at = np.concatenate([[0], np.cumsum(inside.sum(axis=1))])
    sig = W.minhash(flat[inside], at, BANDS, seed=3)
    return sig[used], row[used], begin[used], np.where(valid, shingles, np.uint64(0))


class Templates:
    """A block of templates, ready to be looked up."""

    def __init__(self, texts: Mapping[str, str]):
        self.names = sorted(texts)
        self.shingles, self.words, keys, of = [], [], [], []
        for t, name in enumerate(self.names):
            w = W.one(texts[name].lower(), W.FOLDED, True)
            shingles, valid = W.ngrams(w, W.SHINGLE)
            self.shingles.append(np.unique(shingles[valid]))
            self.words.append(len(w.hash))
            sig = _window_hashes(w, 1)[0]
            keys.append((sig.astype(np.uint64) | (np.arange(BANDS, dtype=np.uint64) << np.uint64(32))).ravel())
            of.append(np.full(sig.size, t))
        keys, of = np.concatenate(keys), np.concatenate(of)
        pairs = np.unique(np.stack([keys.astype(np.uint64), of.astype(np.uint64)]), axis=1)
        self.keys, self.of = pairs[0], pairs[1].astype(np.int64)
        self.bits = np.zeros((BANDS, _BITS), dtype=bool)
        self.bits[(self.keys >> np.uint64(32)).astype(np.int64), (self.keys & np.uint64(_BITS - 1)).astype(np.int64)] = True

    def retrieve(self, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(window, template)`` pairs that share a band."""
        found = []
        for b in range(BANDS):
            at = np.flatnonzero(self.bits[b, sig[:, b] & np.uint32(_BITS - 1)])
            key = sig[at, b].astype(np.uint64) | np.uint64(b << 32)
            lo, hi = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
            window = np.repeat(at, hi - lo)
            if len(window):
                place = np.arange(len(window)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
                found.append(np.stack([window, self.of[place]]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pairs[0], pairs[1]


def _verified(w: W.Words, known: Templates, containment: float) -> Iterator[tuple[int, int, float, int, int]]:
    """``(row, template, share, from, to)``: matches of a slice; overlapping finds of a template count once, the best."""
    sig, row, begin, shingles = _window_hashes(w, STRIDE)
    window, template = known.retrieve(sig)
    order = np.lexsort((begin[window], template, row[window]))
    last: tuple | None = None
    for p, t in zip(window[order].tolist(), template[order].tolist()):
        r, length, own = int(row[p]), known.words[t], known.shingles[t]
        lo = max(int(w.first[r]), int(begin[p]) - length)
        hi = min(int(w.first[r + 1]) - W.SHINGLE + 1, int(begin[p]) + length + WINDOW)
        hit = np.flatnonzero(np.isin(shingles[lo:hi], own))
        # the stretch of one template's length, and some words more, that reaches into the window and holds most of its shingles
        share, start, stop = 0.0, 0, 0
        inside = (int(begin[p]) - lo, int(begin[p]) - lo + WINDOW - W.SHINGLE)
        for k in np.flatnonzero((hit <= inside[1]) & (hit + stretch(length) > inside[0])).tolist():
            upto = int(np.searchsorted(hit, hit[k] + stretch(length)))
            if hit[upto - 1] < inside[0]:
                continue
            part = len(np.unique(shingles[lo + hit[k:upto]])) / len(own)
            if part > share:
                share, start, stop = part, lo + int(hit[k]), lo + int(hit[upto - 1]) + W.SHINGLE
            if share == 1.0:
                break
        if share < containment - 1e-9:
            continue
        here = (r, t, share, start - int(w.first[r]), stop - int(w.first[r]))
        if last and last[:2] == here[:2] and here[3] < last[4]:
            last = max(last, here, key=lambda m: m[2])
            continue
        if last:
            yield last
        last = here
    if last:
        yield last


def compete(found: list[tuple], names: list[str], size: list[int]) -> list[tuple]:
    """The finds of a slice that no better find of another template overlaps."""
    def worth(m: tuple) -> tuple:
        return round(m[2] * size[m[1]]), m[2]

    def beats(a: tuple, b: tuple) -> bool:
        return worth(a) > worth(b) or (worth(a) == worth(b) and names[a[1]] < names[b[1]])

    order = sorted(found, key=lambda m: (m[0], m[3]))
    lost, live = set(), []  # finds that reach the place of the sweep
    for i, m in enumerate(order):
        live = [j for j in live if order[j][0] == m[0] and order[j][4] > m[3]]
        for j in live:
            if order[j][1] != m[1]:
                lost.add(i if beats(order[j], m) else j)
        live.append(i)
    return [m for i, m in enumerate(order) if i not in lost]


def blocks(templates: Mapping[str, str], words: int = BLOCK_WORDS) -> list[dict[str, str]]:
    """The templates in blocks of about ``words`` words."""
    out: list[dict[str, str]] = [{}]
    room = words
    for name in sorted(templates):
        n = len(W.one(templates[name].lower(), W.FOLDED, True).hash)
        if n < W.SHINGLE:
            continue
        if out[-1] and n > room:
            out.append({})
            room = words
        out[-1][name] = templates[name]
        room -= n
    return [b for b in out if b]


def scan(docs: DataFrame, templates: Mapping[str, str] = LICENSES, key: str = "doc_id", text: str = "text",
         containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS, best: bool = False) -> DataFrame:
    """``(key, license, containment, from_word, to_word)``: a row for every place where a document holds a template.

    With ``best`` only the best template of a place.  Templates of one block compete
    where they are found; with several blocks the finds are written once and compared
    by key, text and stretch of the text, so equal rows of a document keep the same finds.
    """
    schema = (f"k {docs.schema[key].dataType.simpleString()}, license string, containment double, from_word long, to_word long, "
              "held long, mark long")
    parts = blocks(templates, block_words)
    alone = best and len(parts) == 1
    found = [_scan_block(docs, Templates(b), key, text, containment, schema, alone) for b in parts]
    out = reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], schema)
    if best and len(parts) > 1:
        out = _best(out)
    return out.drop("held", "mark").withColumnRenamed("k", key)


#: words of a stretch that finds are compared by
_STRETCH = 256


def _best(found: DataFrame) -> DataFrame:
    """Finds that no better find of another template in the same text overlaps."""
    found = written(found, "licenses")
    mine = ["k", "mark", "license", "from_word", "to_word"]
    cells = F.explode(F.sequence(F.floor(F.col("from_word") / _STRETCH), F.floor((F.col("to_word") - 1) / _STRETCH))).alias("cell")
    a = found.dropDuplicates(mine).select(*mine, "held", "containment", cells)
    b = a.toDF(*[f"b_{c}" for c in a.columns])
    better = ((F.col("b_held") > F.col("held"))
              | ((F.col("b_held") == F.col("held")) & ((F.col("b_containment") > F.col("containment"))
                 | ((F.col("b_containment") == F.col("containment")) & (F.col("b_license") < F.col("license"))))))
    lost = a.join(b, F.col("k").eqNullSafe(F.col("b_k")) & (F.col("mark") == F.col("b_mark")) & (F.col("cell") == F.col("b_cell"))
                  & (F.col("license") != F.col("b_license")) & (F.col("b_from_word") < F.col("to_word"))
                  & (F.col("from_word") < F.col("b_to_word")) & better, "left_semi").select(*mine).distinct()
    lost = lost.toDF(*[f"l_{c}" for c in mine])
    same = [F.col(c).eqNullSafe(F.col(f"l_{c}")) for c in mine]
    return found.join(lost, reduce(lambda x, y: x & y, same), "left_anti")


def _scan_block(docs: DataFrame, known: Templates, key: str, text: str, containment: float, schema: str, alone: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for lo, _, w in W.slices(batch.column(1), W.FOLDED, True):
                found = list(_verified(w, known, containment))
                size = [len(x) for x in known.shingles]
                if alone:
                    found = compete(found, known.names, size)
                if found:
                    row, t, share, start, stop = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([lo + r for r in row])), pa.array([known.names[x] for x in t]),
                         pa.array(share, pa.float64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()),
                         pa.array([round(p * size[x]) for p, x in zip(share, t)], pa.int64()), batch.column(2).take(pa.array([lo + r for r in row]))],
                        names=["k", "license", "containment", "from_word", "to_word", "held", "mark"])

    return docs.select(F.col(key).alias("k"), F.lower(text).alias("t"), F.xxhash64(text).alias("mark")).mapInArrow(run, schema)
