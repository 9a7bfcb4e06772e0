import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from .plain import WORD, prose, words

from stratum.llm import quality as Q


RISK = 0.1


def brute(text):
    t = text or ""
    w = words(t)
    tri = collections.Counter(zip(w, w[1:], w[2:]))
    covered = [False] * len(w)
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if tri[x] > 1:
            covered[i] = covered[i + 1] = covered[i + 2] = True
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), sum(covered))


def test_counts_equal_brute_force():
    rng = np.random.default_rng(3)
    texts = [None, "", " \n\t", "a\n\na\n b\n b", "x y z x y z", "é é é é\né é é é", "a\x85b c d\re #*$%&|<>", prose(rng, 30_000, 40)]
    texts += ["".join(rng.choice(list("ab \n#é"), size=int(n))) for n in rng.integers(0, 60, 300)]
    got = Q.measure(pa.array(texts))
    assert list(zip(*(got[k].tolist() for k in Q.STATS))) == [brute(t) for t in texts]


@pytest.mark.parametrize("n,risk,level", [(10, 0.02, 0.05), (500, 0.02, 1e-3), (4000, 0.005, 6e-5)])
def test_most_rejections_is_the_exact_binomial_bound(n, risk, level):
    k = Q.most_rejections(n, risk, level)
    cdf = lambda k: sum(math.comb(n, i) * risk ** i * (1 - risk) ** (n - i) for i in range(k + 1))
    assert k == -1 or cdf(k) <= level
    assert cdf(k + 1) > level


def test_cutoffs_bound_false_rejections_and_verdicts_follow(spark, documents):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 4 == 0
        text = prose(rng, 60) + (" #" * 30 if bad else "")
        rows.append((i, text, "en" if i % 3 else "fr", "s"))
        if i % 2 == 0 or not bad:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(6000, None, None, None), (6001, "", "en", "s"), (6002, prose(rng, 70), None, "s"), (6002, rows[1][1], "en", "s"), (None, prose(rng, 60), "en", "s")]
    docs = documents(rows)
    got = Q.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), risk=RISK).collect()
    assert len(got) == len(rows)
    kept = collections.defaultdict(list)
    for r in got:
        kept[r.doc_id].append(r.kept)
    assert not any(kept[i][0] for i in range(0, 6000, 4))
    assert np.mean([kept[i][0] for i in range(6000) if i % 4]) >= 1 - RISK
    assert kept[6000] == [False] and kept[6001] == [False] and kept[6002] == [True, True] and kept[None] == [True]
    back = Q.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), risk=RISK)
    assert back.columns == docs.columns
    assert back.count() == sum(r.kept for r in got)


def test_without_labels_only_base_rules_judge(spark, documents):
    docs = documents([(1, "a b c", "en", "s"), (2, " ".join(map(str, range(60))), "en", "s")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.kept for r in Q.judge(docs, none).collect()} == {1: False, 2: True}
    assert Q.judge(docs.where("false"), none).count() == 0
