import collections

import numpy as np
import pytest
from .plain import prose, words

from stratum.llm import mixing as M


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, the excess over ``most`` times the size reshared until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        target = {s: most * sizes[s] for s in full} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 1000, "c": 1, None: 30, "é": 7, "Z": 0}, {None: 10}, {"x": 0, "y": 0},
                                   {f"s{k}": int(v) for k, v in enumerate(np.random.default_rng(0).integers(0, 10_000, 40))}])
def test_targets_equal_repeated_resharing(spark, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    got = {r.of: r.target for r in M.targets(spark.createDataFrame(rows, "id long, source string, size long")).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def mixed_rows():
    rng = np.random.default_rng(9)
    rows = [(i, prose(rng, int(rng.integers(1, 120))), "en", "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(900)]
    rows += [(900, prose(rng, 5000), "en", "hot"), (901, None, "en", "hot"), (902, "  ", "en", None), (903, "a b c", "en", None),
             (904, "one two", "en", "only"), (905, "", "en", "blank")]
    return rows + [rows[1]] * 3 + [(None, "x y z", "en", "s1"), (None, "x y", "en", "s1")]


@pytest.mark.parametrize("cell", [16, M.CELL])
def test_mix_meets_targets_and_reruns_agree(documents, cell):
    rows = mixed_rows()
    docs = documents(rows)
    got = M.mix(docs, cell=cell).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), len(words(t))) for i, t, *_ in rows)
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken == r.copies * r.size <= 3 * r.size and r.copies >= 0 and (r.size or r.copies == 0)
    want = plain_targets(dict(size))
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= (130 if size[s] > 100 else 3)
    again = M.mix(docs.repartition(7), cell=cell).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_documents_of_a_source_are_taken_alike(documents):
    """Over many seeds of ids, a document's mean copies approach its source's rate."""
    rng = np.random.default_rng(1)
    rows = [(i, prose(rng, int(rng.integers(1, 60))), "en", f"s{i % 2}") for i in range(4000)]
    got = M.mix(documents(rows)).collect()
    for source in ("s0", "s1"):
        part = [r for r in got if r.source == source]
        rate = part[0].target / part[0].source_size
        for lo, hi in ((1, 20), (20, 40), (40, 60)):
            copies = [r.copies for r in part if lo <= r.size < hi]
            assert abs(np.mean(copies) - rate) < 0.06
            assert set(copies) <= {int(rate), int(rate) + 1}


def test_repeat_gives_the_rows_that_the_mix_takes(documents):
    rows = mixed_rows()
    docs = documents(rows)
    mixed = collections.Counter()
    for r in M.mix(docs).collect():
        mixed[r.doc_id, r.size] += r.copies
    back = M.repeat(docs)
    assert back.columns == docs.columns
    got = collections.Counter((r.doc_id, len(words(r.text))) for r in back.collect())
    assert got == +mixed
    assert M.mix(docs.where("false")).count() == 0 and M.repeat(docs.where("false")).count() == 0


def test_rows_without_id_are_many_cells(spark):
    """100,000 rows under a null id and 20,000 under one repeated id: no cell holds them together."""
    from pyspark.sql import functions as F

    rows = spark.range(130_000).select(
        F.when(F.col("id") >= 120_000, F.col("id")).when(F.col("id") >= 100_000, F.lit(7)).alias("doc_id"),
        F.repeat(F.lit("w "), 1 + (F.col("id") % 3).cast("int")).alias("text"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"))
    got = M.mix(rows)
    sums = {r.source: r for r in got.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target"),
        F.count_distinct("copies").alias("kinds")).collect()}
    assert sum(r.n for r in sums.values()) == 130_000
    assert all(abs(r.taken - r.target) <= 3 and r.kinds <= 2 for r in sums.values())
    null = {r.source: r for r in got.where("doc_id is null").groupBy("source").agg(
        (F.sum("taken") / F.sum("size")).alias("rate"), F.first(F.col("target") / F.col("source_size")).alias("want")).collect()}
    assert all(abs(r.rate - r.want) < 0.02 for r in null.values())
    taken = M.repeat(rows).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w"))).alias("words")).collect()
    assert {r.source: r.words for r in taken} == {s: r.taken for s, r in sums.items()}


def test_repeat_gives_rows_that_share_id_source_and_size_each_an_outcome(spark, monkeypatch):
    """Many rows without id, of one source and size, with different texts, numbered in few lanes."""
    monkeypatch.setattr(M, "_LANES", 3)
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, id, null) as doc_id", "concat('w', id, ' x') as text", "if(id % 2 = 0, 'a', 'b') as source")
    mixed = M.mix(docs).where("doc_id is null").groupBy("source", "copies").count().collect()
    got = M.repeat(docs).where("doc_id is null").groupBy("source", "text").count().groupBy("source", "count").agg({"text": "count"}).collect()
    want = {(r["source"], r["copies"]): r["count"] for r in mixed if r["copies"]}
    assert {(r["source"], r["count"]): r["count(text)"] for r in got} == want and want
