"""Euclidean silhouettes against all pairs."""

import numpy as np
import pytest

from stratum.operators import silhouette as SI


def plain(x, own):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = np.zeros(len(x))
    for i in range(len(x)):
        mates = (own == own[i]) & (np.arange(len(x)) != i)
        others = [d[i, own == c].mean() for c in set(own) - {own[i]}]
        if mates.any() and others:
            a, b = d[i, mates].mean(), min(others)
            out[i] = (b - a) / max(a, b) if max(a, b) else 0.0
    return out


def _table(spark, rng, n, sizes):
    own = np.repeat(np.arange(len(sizes)), sizes)
    x = rng.normal(size=(n, 3)) + own[:, None] * 1.5
    return x, own, spark.createDataFrame([(i, f"c{c}", *map(float, v)) for i, (c, v) in enumerate(zip(own, x))], "id long, c string, a double, b double, d double")


def test_whole_clusters_give_exact_silhouettes(spark, rng):
    x, own, df = _table(spark, rng, 121, [60, 40, 20, 1])
    x[5], x[6] = x[7], x[7]
    df = spark.createDataFrame([(i, f"c{c}", *map(float, v)) for i, (c, v) in enumerate(zip(own, x))], df.schema)
    extra = spark.createDataFrame([(900, None, 1.0, 1.0, 1.0), (901, "c1", None, 1.0, 1.0)], df.schema)
    got = SI.silhouette(df.unionAll(extra), ["a", "b", "d"], "c", ["id"]).orderBy("id").collect()
    assert [r.id for r in got] == list(range(121))
    assert [r.silhouette for r in got] == pytest.approx(plain(x, own), abs=1e-9)
    assert {r.std_err for r in got} == {0.0}


def test_the_standard_error_covers_the_exact_value(spark, rng):
    x, own, df = _table(spark, rng, 1500, [900, 500, 100])
    got = SI.silhouette(df, ["a", "b", "d"], "c", ["id"], sample=100, seed=3).orderBy("id").collect()
    miss = np.abs(np.array([r.silhouette for r in got]) - plain(x, own))
    err = np.array([r.std_err for r in got])
    assert (err > 0).all() and np.mean(miss <= 3 * err) > 0.97 and miss.max() < 0.12
    again = SI.silhouette(df.repartition(7), ["a", "b", "d"], "c", ["id"], sample=100, seed=3).orderBy("id").collect()
    assert [r.silhouette for r in again] == pytest.approx([r.silhouette for r in got])


def test_defined_cases(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 2.0]), (2, 0, [1.0, 2.0])], "id long, c int, v array<double>")
    assert [r.silhouette for r in SI.silhouette(df, "v", "c", ["id"]).collect()] == [0.0, 0.0]
    same = df.selectExpr("id", "CAST(id AS int) % 2 AS c", "v").unionAll(df.selectExpr("id + 2", "CAST(id AS int) % 2", "v"))
    assert [r.silhouette for r in SI.silhouette(same, "v", "c", ["id"]).collect()] == [0.0] * 4
    assert SI.silhouette(df.where("false"), "v", "c", ["id"]).count() == 0
    with pytest.raises(ValueError):
        SI.silhouette(df, "v", "c", ["id"], sample=2)


def test_by_k_prefers_the_true_number(spark, rng):
    centers = np.array([[0, 0], [9, 0], [0, 9]])
    x = np.concatenate([rng.normal(size=(40, 2)) + c for c in centers])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    rows = {r.k: r for r in SI.by_k(df, ["a", "b"], ["id"], [2, 3, 4], n_init=4).collect()}
    assert max(rows, key=lambda k: rows[k].silhouette) == 3
    assert rows[3].silhouette == pytest.approx(plain(x, np.repeat(np.arange(3), 40)).mean(), abs=1e-9) and rows[3].std_err == 0.0
