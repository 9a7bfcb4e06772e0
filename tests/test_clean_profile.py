"""Cleaning, windows, profiling and outliers against pandas brute force (CLN*, WIN*, AGG*, OUT1-OUT2)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum.operators import clean as K
from stratum.operators import outliers as O
from stratum.operators import profile as PR
from stratum.operators import rank as RK
from stratum.plans import panels


@pytest.fixture
def null_panel(spark):
    return panels.with_planted_nulls(panels.customer_year_panel(spark, SF_SMALL))


def _locf_pandas(pdf, cols):
    pdf = pdf.sort_values(["c_custkey", "year"])
    pdf[cols] = pdf.groupby("c_custkey")[cols].ffill()
    return pdf


def test_carry_forward_equals_pandas(spark, null_panel):
    cols = ["avg_value", "max_value", "share_finished"]
    base = null_panel.select("c_custkey", "year", *cols)
    a = K.carry_forward(base, "c_custkey", "year", cols).toPandas().sort_values(["c_custkey", "year"])
    ref = _locf_pandas(base.toPandas(), cols)
    for c in cols:
        np.testing.assert_allclose(a[c].to_numpy(dtype=float), ref[c].to_numpy(dtype=float), equal_nan=True)


def test_scans_with_a_hot_entity_and_awkward_rows(spark, rng):
    """One entity over many partitions and batches, null entities, gaps longer than a partition, text values."""
    import pandas as pd

    n = 3000
    pdf = pd.DataFrame({"e": ["hot"] * n + [f"e{i % 40}" for i in range(900)] + [None] * 60, "t": list(range(n)) + list(range(900)) + list(range(60))})
    pdf["v"] = [f"v{i}" if i % 37 == 0 and not 800 < i < 2200 else None for i in range(len(pdf))]
    pdf["x"] = [float(i) if i % 5 else None for i in range(len(pdf))]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "e string, t long, v string, x double").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        key = lambda r: (r.e or "", r.t)
        got = sorted(K.carry_forward(df, "e", "t", ["v", "x"]).collect(), key=key)
        lag = sorted(K.lag_by_entity(df, "e", "t", "v", drop_missing=False).collect(), key=key)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held, before = {}, {}
    for g, p, r in zip(got, lag, sorted(df.collect(), key=key)):
        for c in ("v", "x"):
            if r[c] is not None:
                held[r.e, c] = r[c]
            assert g[c] == held.get((r.e, c))
        assert p.v == r.v and p.v_lag1 == before.get(r.e)
        before[r.e] = r.v
    assert len(got) == len(pdf)
    assert K.carry_forward(df.where("false"), "e", "t", ["v"]).count() == 0


def test_dedup_first_and_argmin(spark):
    rows = [(1, 3, "b"), (1, 1, "a"), (2, 5, "z"), (2, 5, "y"), (3, 2, "c")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    got = {r["k"]: (r["t"], r["v"]) for r in K.dedup_first(df, ["k"], ["t"]).collect()}
    assert got == {1: (1, "a"), 2: (5, "y"), 3: (2, "c")}
    got2 = {r["k"]: r["v"] for r in K.argmin_by_group(df, ["k"], "t").collect()}
    assert got2 == {1: "a", 2: "y", 3: "c"}


def test_latest_valid_year_skips_missing_target(spark):
    df = spark.createDataFrame([("A", 2014, 1.0), ("A", 2015, None)], "country string, year int, target double")
    assert K.latest_valid_time(df, "year", "target") == 2014
    with pytest.raises(ValueError):
        K.latest_valid_time(df.filter("target IS NULL"), "year", "target")


def test_impute_strategies(spark, null_panel):
    cols = ["avg_value", "max_value"]
    for s in ("median", "mean", "zero"):
        out = K.impute(null_panel, cols, s)
        assert out.filter(F.col("avg_value").isNull() | F.col("max_value").isNull()).count() == 0
    with pytest.raises(ValueError):
        K.impute(null_panel, cols, "bogus")


def test_describe_matches_pandas(spark):
    df = panels.lineitem(spark, SF_SMALL)
    got = PR.describe(df, ["l_quantity", "price_k"]).toPandas().set_index("feature")
    ref = df.select("l_quantity", "price_k").toPandas().describe()
    for c in ["l_quantity", "price_k"]:
        assert got.loc[c, "q25"] == pytest.approx(ref.loc["25%", c])
        assert got.loc[c, "q75"] == pytest.approx(ref.loc["75%", c])
        assert got.loc[c, "std"] == pytest.approx(ref.loc["std", c])


def test_quantile_bins_right_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 11)], "x double")
    got = {r["bin"]: r["n"] for r in PR.quantile_bins(df, "x", 2).collect()}
    ref = pd.qcut(pd.Series(range(1, 11), dtype=float), 2, labels=False).value_counts().sort_index()
    assert list(got.values()) == list(ref.to_numpy()) and sorted(got) == [1, 2]


@pytest.fixture
def outlier_frame(spark, rng):
    f1 = np.concatenate([rng.normal(50, 10, 95), [0.0, 100.0, 150.0, 200.0, -50.0]])
    f2 = rng.normal(20, 5, 100)
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(100), "feature1": f1, "feature2": f2}))


def test_iqr_and_zscore(spark, outlier_frame):
    iqr = O.iqr_fences(outlier_frame, ["feature1", "feature2"], 1.5)
    flagged = iqr.flag(outlier_frame, keep=["id"]).toPandas()
    assert flagged.loc[flagged["id"] >= 97, "feature1_outlier"].all()
    strict = O.iqr_fences(outlier_frame, ["feature1"], 3.0).flag(outlier_frame).toPandas()
    assert strict["feature1_outlier"].sum() <= flagged["feature1_outlier"].sum()
    z = O.zscore_fences(outlier_frame, ["feature1"], 3.0).flag(outlier_frame, keep=["id"]).toPandas()
    pdf = outlier_frame.toPandas()
    ref = (np.abs(pdf.feature1 - pdf.feature1.mean()) / pdf.feature1.std(ddof=1)) > 3
    assert (z["feature1_outlier"].to_numpy() == ref.to_numpy()).all()


def test_isolation_forest_ranks_planted_outliers(spark, outlier_frame):
    from stratum.operators import iforest as IF

    forest = IF.fit(outlier_frame, ["feature1", "feature2"], key=["id"], n_trees=60, psi=64, seed=1)
    s = forest.score(outlier_frame, keep=["id"]).toPandas().sort_values("score", ascending=False)
    assert set(s["id"].head(5)) >= {97, 98, 99}
    again = IF.fit(outlier_frame, ["feature1", "feature2"], key=["id"], n_trees=60, psi=64, seed=1)
    s2 = again.score(outlier_frame, keep=["id"]).toPandas().sort_values("score", ascending=False)
    np.testing.assert_allclose(s["score"].to_numpy(), s2["score"].to_numpy())
    share = IF.flag(forest.score(outlier_frame), contamination=0.05).filter("anomaly").count()
    assert 3 <= share <= 8


def test_global_index_and_average_rank(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("v"))
    idx = RK.global_index(df, ["v"], partitions=4).toPandas()
    assert (idx.sort_values("v")["idx"].to_numpy() == np.arange(1000)).all()
    small = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "k int, s double")
    got = {r["k"]: r["rank"] for r in RK.average_rank(small, "s").collect()}
    assert got == {1: 1.5, 2: 1.5, 3: 3.0}


def test_sorted_quantiles_match_numpy_with_hot_value_and_nulls(spark, rng):
    from stratum.operators.quantiles import quantiles

    x = np.concatenate([rng.normal(size=3000), np.zeros(2000)])
    y = rng.exponential(size=5000)
    rows = [(float(a), None if i % 7 == 0 else float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = quantiles(df, ["x", "y"], probs)
    ys = np.array([r[1] for r in rows if r[1] is not None])
    np.testing.assert_allclose(got["x"], np.quantile(x, probs), rtol=1e-12)
    np.testing.assert_allclose(got["y"], np.quantile(ys, probs), rtol=1e-12)
    from stratum.operators.quantiles import grouped_quantiles

    wild = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), [0.0, -0.0, np.inf, -np.inf, 5e-324]])
    frame = spark.createDataFrame([(("a", "b", None)[i % 3], float(v), None) for i, v in enumerate(wild)], "g string, v double, none double").repartition(5)
    rows = {r.g: r for r in grouped_quantiles(frame, ["v", "none"], [0.0, 0.5, 1.0], "g").collect()}
    assert set(rows) == {"a", "b"} and rows["a"].q1_1 is None
    for k, g in enumerate("ab"):
        np.testing.assert_allclose([rows[g].q0_0, rows[g].q0_1, rows[g].q0_2], np.quantile(wild[k::3], [0.0, 0.5, 1.0]), rtol=1e-12)
    assert quantiles(frame.where("false"), ["v"], [0.5]) == {"v": [None]}


def test_forest_vectorised_walk_matches_naive(spark, outlier_frame):
    from stratum.operators import iforest as IF

    forest = IF.fit(outlier_frame, ["feature1", "feature2"], key=["id"], n_trees=10, psi=32, seed=3)
    x = outlier_frame.select("feature1", "feature2").toPandas().to_numpy()

    def naive(row):
        total = 0.0
        for nodes in forest.trees.values():
            nid = 0
            while True:
                f, split, left, right, size, d = nodes[nid]
                if f < 0:
                    total += d + IF.c_factor(size)
                    break
                nid = left if row[f] < split else right
        return total / len(forest.trees)

    np.testing.assert_allclose(forest.path_lengths(x), [naive(r) for r in x], rtol=1e-12)
