"""Vectorised words and shingles against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import words as W
from .plain import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab c\n\té\x0b\x85 Z!", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_equal_plain_python(texts, limit):
    seen = {}
    for lo, hi, w in W.slices(pa.array(texts, pa.string()), limit=limit):
        for r in range(w.rows):
            at = range(w.first[r], w.first[r + 1])
            assert [w.text(i) for i in at] == words(texts[lo + r])
            for i in at:
                assert seen.setdefault(w.text(i), w.hash[i]) == w.hash[i]
    assert len(set(map(int, seen.values()))) == len(seen)


def test_words_longer_than_a_piece(monkeypatch):
    text = "ab" * 500 + " x " + "ab" * 500 + " " + "ab" * 499 + "ac"
    whole = W.one(text).hash
    monkeypatch.setattr(W, "_PIECE", 64)
    monkeypatch.setattr(W, "_POW", W._POW[:64])
    monkeypatch.setattr(W, "_INV", W._INV[:64])
    cut = W.one(text).hash
    assert (whole == cut).all() and cut[0] == cut[2] and cut[0] != cut[3]


def test_shingle_sets():
    texts = ["a b c d e f a b c d e", "a b", "", None, "a b c d e"]
    for _, _, w in W.slices(pa.array(texts)):
        hashes, at = W.shingle_sets(w)
    assert np.diff(at).tolist() == [6, 1, 0, 0, 1]
    assert hashes[at[4]] in hashes[at[0]:at[1]]


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 62, 200).astype(np.uint64)])
    sig = W.minhash(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 1000, 2000]), 512)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.07
