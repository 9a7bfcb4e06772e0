import collections
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from .plain import prose

from stratum.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=20):
    """(item, rank, id, score) by scoring every document."""
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    total = sum(n for *_, n in counts)
    df = collections.Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        asked = collections.Counter(terms(text))
        found = []
        for i, c, n in counts:
            m = 100 - 25 + 25 * n * len(counts) // total
            s = sum(times * math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, times in asked.items() if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def check(spark, documents, docs, items, **options):
    table = documents([(i, t, "en", "s") for i, t in docs])
    asked = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in items], "item_id long, text string, k string, score string, rank string")
    out = X.search(table, asked, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = [tuple(r) for r in out.collect()]
    assert ordered(got) == ordered(plain(docs, items))
    return got


@pytest.mark.parametrize("options", [{}, {"chunk": 300}, {"block_words": 40}])
def test_ranks_equal_brute_force(spark, documents, options):
    rng = np.random.default_rng(4)
    docs = [(int(i), " ".join(f"w{min(x, 400)}" for x in rng.zipf(1.3, int(n)))) for i, n in enumerate(rng.integers(0, 120, 900))]
    copy = docs[5][1] + " w3 w3"
    docs += [(2000 + i, copy) for i in range(300)]  # ties far beyond the top
    docs += [(None, copy), (None, None), (3000, ""), (3001, " \n"), (3002, "ÄÖ Äö äÖ x"), (7, docs[7][1]), (7, "W1 w2-W3_w4"), (3003, prose(rng, 50_000, 300))]
    items = [(0, "w1 w2 w3 w400"), (1, copy), (2, None), (3, ""), (4, "nowhere to find"), (5, "W9 w9 w9, W17!"), (6, "Äö"), (7, docs[9][1]), (7, docs[11][1]), (None, "w33 w34")]
    check(spark, documents, docs, items, **options)


def test_frequent_terms_ties_and_empty_tables(spark, documents):
    docs = [(i, "the " * (1 + i % 3) + ("a " if i % 2 else "")) for i in range(400)]
    check(spark, documents, docs, [(1, "the a"), (2, "the the")])
    table = documents([(i, t, "en", "s") for i, t in docs])
    asked = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert X.search(table.where("false"), asked).count() == 0
    assert X.search(table, asked.where("false")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 6))
def test_tree_bounds_hold_and_lose_nothing(seed, leaf):
    rng = np.random.default_rng(seed)
    paths = sorted(tuple(sorted(rng.choice(12, size=int(n), replace=False).tolist())) for n in rng.integers(1, 8, 60))
    starts = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
    ranks = np.array([t for p in paths for t in p], dtype=np.int32)
    tf, m = rng.integers(1, 9, len(ranks)), rng.integers(75, 200, len(paths))
    nodes = X.build_tree(starts, ranks, tf, m, leaf)
    held = np.concatenate([np.arange(n.lo, n.lo + len(n.m)) for n in nodes if not n.children])
    assert sorted(held.tolist()) == list(range(len(paths)))
    asked = np.unique(rng.integers(0, 12, 4))
    weights = rng.integers(1, 9000, len(asked))
    score = [sum(int(w) * (10 ** 9 * int(c) // (1000 * int(c) + 12 * int(m[d])))
                 for t, c in zip(ranks[starts[d]:starts[d + 1]], tf[starts[d]:starts[d + 1]]) for a, w in zip(asked, weights) if a == t)
             for d in range(len(paths))]

    def under(i):
        n = nodes[i]
        return list(range(n.lo, n.lo + len(n.m))) if not n.children else [d for c in n.children for d in under(c)]

    for n in nodes:
        bounds = n.scores(asked, weights)
        for c, child in enumerate(n.children):
            assert bounds[c] >= max(score[d] for d in under(child))
    docs, scores = X.branch_and_bound(nodes, asked, weights, [], 5)
    assert all(score[d] == s for d, s in zip(docs, scores))
    floor = max(1, sorted(score)[-5])
    assert sorted(docs.tolist()) == [d for d in range(len(paths)) if score[d] >= floor]
