import zlib

import numpy as np
import pytest
from .plain import prose
from pyspark.sql import functions as F

from stratum.llm import toxicity as X

BAD = ["nastyword", "vileword", "foulword", "rudeword"]


def cases():
    rng = np.random.default_rng(21)
    rows, truth = [], {}
    for i in range(1500):
        text = prose(rng, int(rng.integers(20, 120)), 3000).split()
        truth[i] = int(i % 8 == 0)
        for _ in range(4 * truth[i]):
            text.insert(int(rng.integers(len(text))), BAD[rng.integers(4)] + ("" if i % 3 else "s" * int(rng.integers(1, 4))))
        rows.append((i, " ".join(text), "en", "s"))
    return rows, truth


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy_and_awkward_rows(spark, documents):
    rows, truth = cases()
    extra = [(5000, None, None, None), (5001, "", "en", "s"), (5002, " ", "en", "s"), (None, "nastyword vileword foulword", "en", "s"), rows[8], (5003, "nastyword " * 60_000, "en", "s")]
    labels = [(i, 1, truth[i]) for i in truth if i % 5 < 3] + [(8, 1, 1), (9, 1, None), (None, 1, 1), (99999, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = X.score(documents([*rows, *extra]), frame).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    test = [i for i in truth if held(i)]
    assert np.mean([by[i].predicted == truth[i] for i in test]) > 0.95
    assert np.mean([by[i].predicted for i in test if truth[i]]) > 0.85
    assert by[5000].score == by[5001].score == by[5002].score < 0.5
    assert by[None].predicted == by[5003].predicted == 1
    assert len({r.score for r in got if r.doc_id == 8}) == 1


def test_held_out_labels_change_nothing(spark, documents):
    rows, truth = cases()
    docs = documents(rows)
    one = [(i, 1, truth[i]) for i in truth]
    two = [(i, 0, 1 - truth[i] if held(i) else truth[i]) for i in truth]
    schema = "doc_id long, quality int, toxic int"
    a = {r.doc_id: r.score for r in X.score(docs, spark.createDataFrame(one, schema)).collect()}
    b = {r.doc_id: r.score for r in X.score(docs.withColumn("lang", F.lit("xx")).repartition(5), spark.createDataFrame(two[::-1], schema)).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def plain_step(weight, bias, rows, is_p, prior, decay):
    """The non-negative risk's gradient, text by text."""
    import math

    sig, soft = lambda z: 1 / (1 + math.exp(-z)), lambda z: math.log1p(math.exp(z))
    z = [bias + sum(weight[j] for j in r) for r in rows]
    p, u = [k for k, v in enumerate(is_p) if v], [k for k, v in enumerate(is_p) if not v]
    negative = sum(soft(z[k]) for k in u) / len(u) - prior * sum(soft(z[k]) for k in p) / len(p)
    g = [0.0] * len(rows)
    for k in p:
        g[k] = prior * (-sig(-z[k]) - sig(z[k])) / len(p) if negative >= 0 else prior * sig(z[k]) / len(p)
    for k in u:
        g[k] = (1 if negative >= 0 else -1) * sig(z[k]) / len(u)
    return [sum(g[k] for k, r in enumerate(rows) if j in r) + decay * weight[j] for j in range(len(weight))], sum(g)


def test_fit_equals_plain_steps():
    """Few rows, so that every step sees all of them: Adam on the risk, weight by weight."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows = [sorted(rng.choice(6, size=int(rng.integers(1, 5)), replace=False).tolist()) for _ in range(240)]
    is_p = [k < 80 for k in range(240)]
    rows = [sorted(set(r) | ({0} if v else set())) for r, v in zip(rows, is_p)]
    table = pa.table({"positive": pa.array(is_p), "codes": pa.array(rows, pa.list_(pa.int32()))})
    prior, decay = 0.3, 1e-3
    got, bias = X.fit(table, prior, steps=25, decay=decay)
    known = np.flatnonzero(got[:6])
    assert len(known) >= 1
    own = [[int(np.flatnonzero(known == c)[0]) for c in r if c in known] for r in rows]
    w, b = [0.0] * len(known), float(np.log(prior / (1 - prior)))
    m, v = [0.0] * (len(known) + 1), [0.0] * (len(known) + 1)
    for step in range(1, 26):
        grad, gb = plain_step(w, b, own, is_p, prior, decay)
        new = []
        for j, g in enumerate([*grad, gb]):
            m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.999 * v[j] + 0.001 * g * g
            new.append(X.RATE * (m[j] / (1 - 0.9 ** step)) / ((v[j] / (1 - 0.999 ** step)) ** 0.5 + 1e-6))
        w, b = [x - d for x, d in zip(w, new)], b - new[-1]
    assert got[known] == pytest.approx(w, abs=1e-5) and bias == pytest.approx(b, abs=1e-5)


def test_sample_takes_one_text_an_id(spark, documents):
    rows, truth = cases()
    long = ("nastyword " * 9000, "en", "s")
    docs = documents([*rows[:300], *[rows[8]] * 50, (8, *long), (11, *long)])
    labels = spark.createDataFrame([(i, 1, truth[i]) for i in range(300)], "doc_id long, quality int, toxic int")
    got, _ = X.sample(docs, labels, "doc_id", "text", "toxic", 1000, 1000)
    learnt = [i for i in range(300) if not held(i)]
    assert got.num_rows == len(learnt) + sum(truth[i] for i in learnt)


def test_without_positives_or_rows(spark, documents):
    rows, _ = cases()
    docs = documents(rows[:50])
    schema = "doc_id long, quality int, toxic int"
    assert {r.score for r in X.score(docs, spark.createDataFrame([], schema)).collect()} == {0.0}
    assert {r.predicted for r in X.score(docs, spark.createDataFrame([(i, 1, 0) for i in range(50)], schema)).collect()} == {0}
    assert X.score(docs.where("false"), spark.createDataFrame([(1, 1, 1)], schema)).count() == 0
