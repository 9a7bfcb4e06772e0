import numpy as np
import pandas as pd
import pytest

from stratum.operators import forest as FO
from stratum.operators import smooth as SM

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 1500
    frame = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.integers(0, 6, n).astype(float), "c": rng.standard_cauchy(n),
                          "d": np.where(rng.random(n) < 0.7, 2.0, rng.normal(size=n))})
    frame["y"] = 1e6 + 3 * frame["a"] * frame["b"] + np.clip(frame["c"], -3, 3) + rng.normal(size=n) / 4
    return frame


def plain_tree(x, y, w, may, depth):
    """Splits node by node; ``(leaf value of any row, gain by feature)``."""
    gains = np.zeros(x.shape[1])

    def grow(own, place, level):
        mean = (w[own] * y[own]).sum() / w[own].sum()
        best = (0.0, None, None)
        if level < depth:
            for f in may[2**level - 1 + place]:
                for cut in range(FO.MAX_BINS - 1):
                    l, r = own[x[own, f] <= cut], own[x[own, f] > cut]
                    wl, wr = w[l].sum(), w[r].sum()
                    if wl and wr:
                        gain = wl * wr / (wl + wr) * ((w[l] * y[l]).sum() / wl - (w[r] * y[r]).sum() / wr) ** 2
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, f, cut)
        gain, f, cut = best
        if f is None:
            return lambda v: mean
        gains[f] += gain
        left, right = grow(own[x[own, f] <= cut], 2 * place, level + 1), grow(own[x[own, f] > cut], 2 * place + 1, level + 1)
        return lambda v: left(v) if v[f] <= cut else right(v)

    return grow(np.flatnonzero(w), 0, 0), gains


def test_equals_plain_trees(spark, rows):
    trees, depth, seed = 5, 4, 3
    df = spark.createDataFrame(rows).selectExpr("*", "id % 5 = 0 AS held", f"xxhash64({seed}, id) AS h")
    forest, pred = FO.fit(df, "y", FEATURES, ["id"], "held", trees, depth, seed)
    all_ = df.toPandas()
    x = np.column_stack([np.searchsorted(c, all_[f], side="left") for f, c in zip(FEATURES, forest.thresholds)])
    y, held, h = all_["y"].to_numpy() - 1e6, all_["held"].to_numpy(), all_["h"].to_numpy().astype(np.uint64)
    total, gains = np.zeros(held.sum()), np.zeros(4)
    for t in range(trees):
        w = FO.draws(h, t // 2)[t % 2].astype(float) * ~held
        tree, gain = plain_tree(x, y, w, FO.asked(seed, t, depth, 4, 2), depth)
        total += [tree(v) for v in x[held]]
        gains += gain / gain.sum()
    got = pred.toPandas().sort_values("y")
    order = np.argsort(y[held])
    np.testing.assert_allclose(got["prediction"], 1e6 + total[order] / trees, rtol=0, atol=1e-6)
    np.testing.assert_allclose(forest.importances, gains / gains.sum(), rtol=1e-6)


def test_does_not_depend_on_how_rows_are_dealt(spark, rows):
    found = []
    for parts in (2, 7):
        metrics, importances = SM.random_forest(spark.createDataFrame(rows).repartition(parts, "b", "id"), "y", FEATURES, ["id"], n_trees=20, max_depth=5)
        found.append([*metrics.first(), *(r["importance"] for r in importances.collect())])
    np.testing.assert_allclose(found[0], found[1], rtol=1e-9)


def test_near_the_library(spark, rows):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    df = spark.createDataFrame(rows).selectExpr("*", "id % 5 = 0 AS held")
    _, pred = FO.fit(df, "y", FEATURES, ["id"], "held", 60, 6, 1)
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    other = RandomForestRegressor(labelCol="y", numTrees=60, maxDepth=6, seed=1).fit(data.where("NOT held")).transform(data.where("held"))
    ours, theirs = (p.selectExpr("sqrt(avg((y - prediction) * (y - prediction)))").first()[0] for p in (pred, other))
    assert ours == pytest.approx(theirs, rel=0.15)


def test_several_scans_a_level_and_single_features(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows).selectExpr("*", "id % 5 = 0 AS held")
    whole, _ = FO.fit(df, "y", FEATURES, ["id"], "held", 7, 4, 1)
    monkeypatch.setattr(FO, "_SUMS", 1)
    parts, _ = FO.fit(df, "y", FEATURES, ["id"], "held", 7, 4, 1)
    for name in ("feature", "cut", "value"):
        np.testing.assert_array_equal(getattr(whole, name), getattr(parts, name))


def test_nothing_to_split(spark, rows):
    df = spark.createDataFrame(rows.assign(y=4.5)).selectExpr("*", "id % 5 = 0 AS held")
    forest, pred = FO.fit(df, "y", ["a", "b"], ["id"], "held", 4, 3, 1)
    assert {r["prediction"] for r in pred.collect()} == {4.5}
    assert not forest.importances.any()
    df = spark.createDataFrame(rows.assign(a=1.0)).selectExpr("*", "id % 5 = 0 AS held")
    forest, pred = FO.fit(df, "y", ["a"], ["id"], "held", 4, 3, 1)
    assert pred.selectExpr("max(prediction) - min(prediction)").first()[0] == 0.0
    with pytest.raises(ValueError):
        FO.fit(df.where("held"), "y", ["a"], ["id"], "held", 4, 3, 1)


def test_thresholds():
    np.testing.assert_array_equal(FO.thresholds(np.array([1.0, 3, 3, 2, 1])), [1.5, 2.5])
    cuts = FO.thresholds(np.arange(3200.0))
    assert len(cuts) == 31
    assert set(np.diff(cuts)) == {100.0}
    assert len(FO.thresholds(np.full(50, 7.0))) == 0


def test_draws_are_poisson():
    h = np.random.default_rng(1).integers(0, 2**63, 200_000).astype(np.uint64)
    a, b = FO.draws(h, 3).astype(float)
    for v in (a, b):
        assert v.mean() == pytest.approx(1.0, abs=0.01)
        assert v.var() == pytest.approx(1.0, abs=0.02)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01
    assert abs(np.corrcoef(a, FO.draws(h, 4)[0])[0, 1]) < 0.01
