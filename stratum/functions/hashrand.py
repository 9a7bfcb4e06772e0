"""Deterministic per-row random numbers from md5.

``u(key, seed) = int(first 8 hex digits of md5(seed || '|' || key)) / 2^32``.
The same number comes out of Spark and of any SQL engine with ``md5``, so
folds, splits and bootstrap weights built on it can be checked by SQL.
No state, no driver round trip: every executor computes its rows' values.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(2**32)


def row_key(*cols: str | Column) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if len(parts) == 1:
        return parts[0].cast("string")
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def uniform(seed: int | str | Column, *key: str | Column) -> Column:
    """Uniform [0, 1) from md5 of ``seed|key``; ``seed`` may be a column (replicate id)."""
    s = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat(s, F.lit("|"), row_key(*key)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_SCALE)


def uniform_py(seed: int | str, key: object) -> float:
    """Driver/pandas twin of :func:`uniform` for a single value."""
    digest = hashlib.md5(f"{seed}|{key}".encode()).hexdigest()
    return int(digest[:8], 16) / _SCALE


def fold_id(seed: int, k: int, *key: str | Column) -> Column:
    """Shuffled K-fold assignment: ``floor(u * k)`` in 0..k-1."""
    return F.floor(uniform(seed, *key) * F.lit(k)).cast("int")


# Cumulative Poisson(1) probabilities P(X <= j), j = 0..9, from the rule
# e^-1 * sum_{i<=j} 1/i!; turns a uniform into a Poisson(1) count.
POISSON1_CDF = tuple(
    math.exp(-1.0) * sum(1.0 / math.factorial(i) for i in range(j + 1)) for j in range(10)
)


def poisson1_from(u: Column) -> Column:
    """Poisson(1) count from a uniform: the number of CDF steps at or below ``u``.

    Written as one CASE with ascending thresholds: evaluation stops at the
    first match, so ``u`` (an md5) is evaluated about twice per row on average
    even when the optimizer inlines it.
    """
    expr = F.when(u < F.lit(POISSON1_CDF[0]), F.lit(0))
    for j, p in enumerate(POISSON1_CDF[1:], start=1):
        expr = expr.when(u < F.lit(p), F.lit(j))
    return expr.otherwise(F.lit(len(POISSON1_CDF)))


def poisson1(seed: int | str | Column, *key: str | Column) -> Column:
    """Poisson(1) count per (replicate, row).

    Materialise :func:`uniform` as a column first when the count is used more
    than once so md5 runs once per (replicate, row).
    """
    return poisson1_from(uniform(seed, *key))


_MD5_TURNS = (7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)
_MD5_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: rows that a pass of the hash takes at once
_ROWS = 1 << 12


def _md5_heads(words: Sequence[np.ndarray | int]) -> np.ndarray:
    """First 32 bits (as their hex digits read) of the md5 of one-block messages: 16 words, each a column or one number for all rows."""
    n = max(len(w) for w in words if not isinstance(w, int))
    a, b, c, d = (np.full(n, v, dtype=np.uint32) for v in _MD5_START)
    f, high = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        word = words[(i, 5 * i + 1, 3 * i + 5, 7 * i)[kind] % 16]
        if isinstance(word, int):
            a += np.uint32((_MD5_SINES[i] + word) % 2**32)
        else:
            a += np.uint32(_MD5_SINES[i])
            a += word
        f += a
        turn = _MD5_TURNS[kind][i % 4]
        np.right_shift(f, np.uint32(32 - turn), out=high)
        f <<= np.uint32(turn)
        f |= high
        np.add(f, b, out=a)  # the next b; a's room is free
        a, b, c, d = d, a, b, c
    return (a + np.uint32(_MD5_START[0])).byteswap()


_POISSON1_STEPS = [math.ceil(p * 2**32) for p in POISSON1_CDF]


def poisson1_table(keys: pa.Array, seeds: Sequence[str]) -> np.ndarray:
    """``poisson1(seed, key)`` for all rows (down) and seeds (across): the same counts, many rows a step.

    The seed and a bar are put before a row's key.  Keys that leave no room in one
    block of the hash are taken one by one; NULL counts as in :func:`poisson1_from`.
    """
    out = np.empty((len(keys), len(seeds)), dtype=np.uint8)
    texts = [None if k is None else k.encode() for k in keys.to_pylist()]
    heads = [f"{s}|".encode() for s in seeds]
    room = 55 - max(map(len, heads), default=0)
    plain = np.array([i for i, k in enumerate(texts) if k is not None and len(k) <= room], dtype=np.int64)
    for i in set(range(len(texts))) - set(plain.tolist()):
        k = texts[i]
        for j, s in enumerate(heads):
            h = 2**32 if k is None else int(hashlib.md5(s + k).hexdigest()[:8], 16)
            out[i, j] = sum(h >= p for p in _POISSON1_STEPS)
    for lo in range(0, len(plain), _ROWS):
        rows = plain[lo:lo + _ROWS]
        sizes = np.array([len(texts[i]) for i in rows])
        for start in {len(s) for s in heads}:
            block = np.zeros((len(rows), 64), dtype=np.uint8)
            joined = b"".join((texts[i] + b"\x80").ljust(64 - start, b"\0") for i in rows)
            block[:, start:] = np.frombuffer(joined, dtype=np.uint8).reshape(len(rows), -1)
            block[:, 56:] = (8 * (sizes + start)).astype("<u8").view(np.uint8).reshape(-1, 8)
            columns = np.ascontiguousarray(block.view("<u4").T)
            words = [int(w[0]) if (w == w[0]).all() else w for w in columns]
            for j, s in enumerate(heads):
                if len(s) == start:
                    front = np.frombuffer(s.ljust(64, b"\0"), dtype="<u4").tolist()
                    own = [w | f if isinstance(w, int) else (w | np.uint32(f) if f else w) for w, f in zip(words, front)]
                    if all(isinstance(w, int) for w in own):
                        own[15] = np.full(len(rows), own[15], dtype=np.uint32)
                    h = _md5_heads(own)
                    count = np.zeros(len(rows), dtype=np.uint8)
                    for p in _POISSON1_STEPS:
                        count += h >= np.uint32(p)
                    out[rows, j] = count
    return out
