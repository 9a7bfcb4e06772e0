import collections
import itertools
import math

import numpy as np
import pytest
from .plain import prose, words

from stratum.llm import jaccard as J
from stratum.llm.components import components


def sets(rows):
    out = []
    for _, text, *_ in rows:
        w = words(text)
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(rows, threshold=0.8):
    """Links and class of every row by comparing all pairs."""
    s, n = sets(rows), len(rows)
    label, links = [r[0] for r in rows], [0] * n
    pairs = [(i, j) for i, j in itertools.combinations(range(n), 2)
             if s[i] and s[j] and len(s[i] & s[j]) >= threshold * len(s[i] | s[j]) - 1e-9]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    while True:
        before = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            return links, label


def near(rng, text, share):
    w = text.split()
    for i in rng.choice(len(w), max(1, int(len(w) * share)), replace=False):
        w[i] = f"edit{rng.integers(0, 10**9)}"
    return " ".join(w)


@pytest.fixture
def rows():
    rng = np.random.default_rng(11)
    texts = [prose(rng, int(n)) for n in rng.integers(1, 200, 60)]
    hot = prose(rng, 150)
    texts += [near(rng, hot, 0.005) for _ in range(90)]  # a third of all rows: one group of near copies
    texts += [texts[3]] * 40 + [near(rng, t, s) for t in texts[:40] for s in (0.01, 0.03, 0.05)]
    texts += ["", " \n ", None, None, "one", "one", "one two three four", prose(rng, 20_000)]
    texts.append(near(rng, texts[-1], 0.01))
    return [(i, t, "en", "s") for i, t in enumerate(texts)]


@pytest.mark.parametrize("block", [J.BLOCK, 2_000])
def test_links_and_classes_equal_all_pairs(documents, rows, block):
    links, label = brute(rows)
    got = {r.doc_id: r for r in J.near_duplicates(documents(rows), block=block).collect()}
    assert [got[r[0]].n_links for r in rows] == links
    assert [got[r[0]].class_id for r in rows] == label


def test_one_of_each_keeps_the_smallest_id(documents, rows):
    docs = documents([*rows, rows[0], rows[0], (None, rows[0][1], "en", "s"), (None, "alone as it is in all the table", None, None)])
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    label = brute(rows)[1]
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(label))
    assert J.one_of_each(docs.where("false")).count() == 0


def test_posterior_bound():
    """The pruning bound is the least m whose Beta posterior tail reaches the tolerance (numeric integral)."""
    t, tol = 0.8, 1e-4
    x = np.linspace(t, 1, 20001)
    for n in (16, 64, 128):
        tail = [np.trapezoid(x ** m * (1 - x) ** (n - m), x) * (n + 1) * math.comb(n, m) for m in range(n + 1)]
        assert J.least_matches(t, tol, n) == next(m for m in range(n + 1) if tail[m] >= tol)


def test_components_of_a_long_chain(spark):
    n = 300
    order = np.random.default_rng(1).permutation(n).tolist()
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1002), (7000, 7000)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000, 1002: 1000}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert collections.Counter(got.values())[0] == n


def test_groups_of_short_texts_are_cut_by_rows(spark, documents, rows):
    """50,000 different texts of 6 to 10 words that share most of their shingles are few shingles but many rows."""
    from pyspark.sql import functions as F

    texts = spark.range(50_000).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.slice(F.split(F.lit("a b c d e f g h i"), " "), F.lit(1), F.lit(5) + (F.col("id") % 5).cast("int")), F.col("id").cast("string")).alias("text"))
    reps = J.fingerprints(texts).select("key", "size", "bands")
    groups = J.candidate_groups(reps).select("key", F.explode("groups").alias("g")).groupBy("g.group", "g.blocks").count().collect()
    assert max(g["count"] for g in groups) > 10 * J.BLOCK_ROWS
    assert all(g["count"] <= g["blocks"] * J.BLOCK_ROWS for g in groups)
    links, label = brute(rows)
    got = {r.doc_id: r for r in J.near_duplicates(documents(rows), block_rows=20).collect()}
    assert [got[r[0]].n_links for r in rows] == links and [got[r[0]].class_id for r in rows] == label


def test_blocks_of_many_shared_groups_are_compared_fast():
    """2,000 rows in eight shared groups each: pairs that met before are left out group by group, not row by row."""
    import time

    rng = np.random.default_rng(0)
    rows, k = 2000, 128
    groups = np.sort(rng.integers(0, 4000, (rows, 8)), axis=1)
    shingles = np.sort(rng.integers(0, 1 << 62, (rows, 50)).astype(np.uint64), axis=1)
    sig = rng.integers(0, 1 << 32, (rows, k)).astype(np.uint32)
    sig[1::2], shingles[1::2] = sig[::2], shingles[::2]
    groups[1::4] = groups[::4]  # these pairs have met
    g = {"sig": sig, "at": np.arange(rows + 1) * 50, "shingles": shingles.ravel(), "groups": groups.ravel(), "groups_at": np.arange(rows + 1) * 8, "group": 5000}
    began = time.time()
    i, j = J._links(g, np.arange(rows), np.arange(rows), True, 0.8, 1e-9)
    assert time.time() - began < 10
    assert sorted(zip(i.tolist(), j.tolist())) == [(x, x + 1) for x in range(0, rows, 2) if not set(groups[x]) & set(groups[x + 1])]
