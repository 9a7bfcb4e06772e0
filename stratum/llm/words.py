"""Vectorised words and shingles over Arrow string columns.

A task receives Arrow batches of whole texts.  ``slices`` walks a batch in runs
of whole rows of about ``limit`` bytes and turns each run into word arrays with
a few numpy passes over its UTF-8 bytes: no Python object per word.  Words are
64-bit hashes of their bytes; a run's memory is a small multiple of ``limit``
or of its one longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 20
SHINGLE = 5

#: bytes of a word for ``[^\x20\x09-\x0D]+``: everything but ASCII white space
PLAIN = np.ones(256, dtype=bool)
PLAIN[[0x20, 9, 10, 11, 12, 13]] = False
#: bytes of a word for folded text: ASCII letters and digits, and every byte of other characters
FOLDED = np.zeros(256, dtype=bool)
FOLDED[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finalizer (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = x.astype(_U, copy=True)
        x ^= x >> _U(33)
        x *= _U(0xFF51AFD7ED558CCD)
        x ^= x >> _U(29)
        x *= _U(0xC4CEB9FE1A85EC53)
        x ^= x >> _U(32)
    return x


def _byte_values(fold: bool) -> np.ndarray:
    codes = np.arange(256)
    if fold:
        codes[65:91] += 32
    return mix(codes.astype(_U) * _U(0x2545F4914F6CDD1D) + _U(0x632BE59BD9B4E019))


_VALUES = {False: _byte_values(False), True: _byte_values(True)}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=_U)


_POW = _powers(_BASE, _PIECE)
_INV = _powers(pow(_BASE, -1, 1 << 64), _PIECE)


@dataclass
class Words:
    """Words of consecutive rows: ``first[r]:first[r + 1]`` are those of row ``r``."""

    data: np.ndarray
    row_start: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts())

    def text(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


def _hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), dtype=_U)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(start):
            base = start[i]
            j = int(np.searchsorted(end, base + _PIECE, side="right"))
            if j > i:  # whole words of one piece: prefix sums of value * base^position
                piece = values[data[base:end[j - 1]]]
                piece *= _POW[:len(piece)]
                sums = np.concatenate([np.zeros(1, _U), np.cumsum(piece, dtype=_U)])
                out[i:j] = (sums[end[i:j] - base] - sums[start[i:j] - base]) * _INV[start[i:j] - base]
                i = j
            else:  # one word longer than a piece: its pieces one after the other
                total, shift, step = _U(0), _U(1), _U(pow(_BASE, _PIECE, 1 << 64))
                for a in range(int(base), int(end[i]), _PIECE):
                    piece = values[data[a:min(a + _PIECE, int(end[i]))]]
                    total = total + shift * np.sum(piece * _POW[:len(piece)], dtype=_U)
                    shift = shift * step
                out[i] = total
                i += 1
    return mix(out)


def split(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = PLAIN, fold: bool = False) -> Words:
    """Words of the rows ``data[offsets[r]:offsets[r + 1]]``."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, np.asarray(offsets), start, end, _hash_words(data, start, end, _VALUES[fold]), first)


def slices(texts: pa.Array, table: np.ndarray = PLAIN, fold: bool = False,
           limit: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """``(from_row, to_row, words)`` over a string array; nulls count as empty texts."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, off, buf = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        part = data[offsets[lo]:offsets[hi]]
        yield lo, hi, split(part, offsets[lo:hi + 1] - offsets[lo], table, fold)
        lo = hi


def one(text: str, table: np.ndarray = PLAIN, fold: bool = False) -> Words:
    """Words of one text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return split(data, np.array([0, len(data)]), table, fold)


def ngrams(words: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, valid)`` by word position: the n words from there on, if the row has them.

    With ``short`` a row of 1 to n - 1 words has one n-gram, made of all its words.
    """
    total = len(words.hash)
    last = np.repeat(words.first[1:], words.counts())
    at = np.arange(total)
    out = np.zeros(total, dtype=_U)
    with np.errstate(over="ignore"):
        for k in range(n):
            term = np.zeros(total, dtype=_U)
            term[:total - k] = words.hash[k:]
            if short:
                term[at + k >= last] = _U(0x1B873593CC9E2D51)
            out += mix(term + _U(k * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
    valid = at + n <= last
    if short:
        valid |= at == np.repeat(words.first[:-1], words.counts())
    return out, valid


def shingle_sets(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row, one after the other, and the rows' offsets into them."""
    hashes, valid = ngrams(words, n, short=True)
    rows, hashes = words.row_of()[valid], hashes[valid]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    if len(rows):
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        rows, hashes = rows[fresh], hashes[fresh]
    return hashes, np.searchsorted(rows, np.arange(words.rows + 1))


def minhash(hashes: np.ndarray, offsets: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """``rows x k`` MinHash values (uint32); rows without shingles get the maximum everywhere."""
    out = np.full((len(offsets) - 1, k), np.iinfo(np.uint32).max, dtype=np.uint32)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    rng = np.random.default_rng(seed)
    a = (rng.integers(0, 1 << 31, size=k, dtype=np.uint64) * _U(2) + _U(1)).astype(np.uint32)
    b = rng.integers(0, 1 << 32, size=k, dtype=np.uint64).astype(np.uint32)
    low, high = hashes.astype(np.uint32), (hashes >> _U(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for j in range(k):
            values = (low if j % 2 else high) * a[j] + b[j]
            out[full, j] = np.minimum.reduceat(values, offsets[full])
    return out


def list_column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))
