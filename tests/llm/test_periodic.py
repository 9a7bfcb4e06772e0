import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from .plain import prose, words

from stratum.llm import periodic as P
from stratum.llm import queries


def plain_lyndon(x):
    """Longest Lyndon word at each place: up to the next smaller suffix."""
    n = len(x)
    return [next((j for j in range(i + 1, n) if x[j:] < x[i:]), n) - i for i in range(n)]


def plain_runs(x, min_length=24, min_exponent=3):
    out = []
    for p in range(1, len(x) // min_exponent + 1):
        i = 0
        while i + p < len(x):
            if x[i] != x[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(x) and x[j] == x[j + p]:
                j += 1
            length = j + p - i
            if length >= max(min_length, min_exponent * p) and not any(
                    p % q == 0 and all(x[k] == x[k + q] for k in range(i, i + length - q)) for q in range(1, p)):
                out.append((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    w = words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(v for k, v in enumerate(w) if k not in gone)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_lyndon_arrays_under_both_orders(x):
    letters = max(x, default=0) + 1
    assert P.lyndon_array(x, letters) == plain_lyndon(x)
    back = [letters - 1 - v for v in x]
    assert P.lyndon_array(back, letters) == plain_lyndon(back)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=60), st.integers(2, 4), st.integers(1, 12))
def test_runs_equal_brute_force(x, exponent, length):
    got = P.runs_of(np.array(x, dtype=np.uint64), length, exponent) if x else np.zeros((0, 3), int)
    assert [tuple(r) for r in got.tolist()] == plain_runs(x, length, exponent)


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("x", [thue_morse(4096), fibonacci(900), [0] * 3000, [0, 1] * 700 + [1, 0] * 700])
def test_words_known_for_their_repeats(x):
    assert [tuple(r) for r in P.runs_of(np.array(x, dtype=np.uint64)).tolist()] == (plain_runs(x) if len(x) < 4000 else [])


TEXTS = [None, "", " \n\t\x0b", "a " * 23, "a " * 24, "a\n" * 25 + "b", "x " + "a b c d e f g h i " * 3 + "a b y", "a b c d e f g h " * 3,
         "é\x85ü " * 40 + "x y " * 30, ("a b " * 14 + "c ") * 5, "a b a b " * 6 + "b a b a " * 6, ("p q r " * 9 + "s ") * 4 + "p q r " * 9]


def test_query_digest_equals_brute_force(spark, documents, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(rng.choice(["a", "b", "c"], size=int(n))), "en", "s") for i, n in enumerate(rng.integers(0, 300, 150))]
    rows += [(400 + i, prose(rng, int(n), 50), None, "s") for i, n in enumerate(rng.integers(1, 400, 100))]
    rows += [(None, "a b " * 20, "en", "s"), (None, None, None, None), (7, "z " * 30, "en", "s"), (7, "z " * 30, "en", "s")]
    monkeypatch.setattr(queries, "table", lambda *_: documents(rows))
    got = queries.op13_periodic_runs(spark, "").collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=key) == sorted((plain_digest(r[0], r[1]) for r in rows), key=key)
    assert any(r.n_runs > 1 for r in got)


def test_long_texts_and_empty_tables(spark, documents):
    rng = np.random.default_rng(2)
    long = prose(rng, 60_000) + " " + "one two three four five " * 20_000 + prose(rng, 60_000) + " x" * 50_000
    out = P.detect(documents([(1, long, "en", "s")])).collect()[0]
    tail = len(long.split()) - 50_000
    assert [(r.start, r.length, r.period) for r in out.runs] == [(60_000, 100_000, 5), (tail, 50_000, 1)]
    assert len(out.collapsed.split()) == 120_000 + 5 + 1
    empty = P.detect(documents([(1, "a", "en", "s")]).where("false"), keep=("doc_id", "key"))
    assert empty.columns == ["doc_id", "key", "runs", "collapsed"] and empty.count() == 0
