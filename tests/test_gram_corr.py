"""GRAM core and correlation (COR1-COR5) against numpy; reference-style fixtures (F5)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, to_np
from stratum.operators import corr as C
from stratum.operators.gram import gram
from stratum.plans import panels

LI = panels.LINEITEM_FEATURES


def test_gram_matches_numpy(spark):
    df = panels.lineitem(spark, SF_SMALL)
    x = to_np(df, LI)
    g = gram(df, LI)
    assert g.n == len(x)
    np.testing.assert_allclose(g.means, x.mean(0), rtol=1e-12)
    np.testing.assert_allclose(g.cov(), np.cov(x, rowvar=False), rtol=1e-9)
    np.testing.assert_allclose(g.corr(), np.corrcoef(x, rowvar=False), atol=1e-12)


def test_wide_and_weighted_paths_agree(spark, monkeypatch):
    from stratum.operators import gram as G

    df = panels.lineitem(spark, SF_SMALL)
    narrow = gram(df, LI)
    monkeypatch.setattr(G, "NARROW_K", 1)  # force the Arrow X'X route
    wide = G.gram(df, LI)
    np.testing.assert_allclose(wide.cross, narrow.cross, rtol=1e-9)
    weighted = G.gram(df.withColumn("w", F.lit(1.0)), LI, weight="w")
    np.testing.assert_allclose(weighted.cross, narrow.cross, rtol=1e-9)


def test_grouped_gram_sums_to_total(spark):
    df = panels.lineitem(spark, SF_SMALL).withColumn("g", (F.col("l_orderkey") % 3).cast("int"))
    total = gram(df, LI)
    parts = gram(df, LI, by="g")
    rest = total - parts[0]
    x = to_np(df.filter("g != 0"), LI)
    np.testing.assert_allclose(rest.means, x.mean(0), rtol=1e-9)
    np.testing.assert_allclose(rest.cross, np.cov(x, rowvar=False) * (len(x) - 1), rtol=1e-7)


@pytest.fixture
def corr_frame(spark):
    rows = [(float(i), 2.0 * i, float(6 - i), 10.0 + 5 * (i - 1)) for i in range(1, 6)]
    return spark.createDataFrame(rows, "feature1 double, feature2 double, feature3 double, target double")


def test_perfect_correlations(spark, corr_frame):
    res = C.correlation(corr_frame, ["feature1", "feature2", "feature3"], target="target")
    m = dict(zip(res.columns, range(4)))
    assert res.matrix[m["feature1"], m["feature2"]] == pytest.approx(1.0)
    assert res.matrix[m["feature1"], m["feature3"]] == pytest.approx(-1.0)
    top = res.top_pairs(spark, n=3).collect()
    assert [r["abs_correlation"] for r in top] == pytest.approx([1.0, 1.0, 1.0])


def test_target_correlations_sorted_and_errors(spark, corr_frame):
    out = C.target_correlations(corr_frame, ["feature1", "feature2", "feature3"], "target").collect()
    assert [r["feature"] for r in out] == ["feature1", "feature2", "feature3"]
    with pytest.raises(ValueError):
        C.target_correlations(corr_frame.drop("target"), ["feature1"], "target")
    with pytest.raises(ValueError):
        C.target_correlations(corr_frame, ["feature1"], None)


def test_pairwise_complete_with_null(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 6.5), (4.0, 8.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    res = C.correlation(df, ["a", "b"])
    a = np.array([1.0, 3.0, 4.0])
    b = np.array([2.0, 6.5, 8.0])
    assert res.matrix[0, 1] == pytest.approx(np.corrcoef(a, b)[0, 1])


def test_constant_column_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    res = C.correlation(df, ["a", "c"], pairwise=False)
    assert np.isnan(res.matrix[0, 1])
    rows = res.tidy(spark).filter("feature_a = 'a' AND feature_b = 'c'").collect()
    assert rows[0]["correlation"] is None


def test_pairwise_moments_match_pandas(spark, rng):
    import pandas as pd

    from stratum.operators.gram import pairwise_corr

    x = rng.normal(size=(400, 8))
    x[:, 1] += x[:, 0]
    mask = rng.random((400, 8)) < 0.15
    x[mask] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(8)])
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(8)))
    got = pairwise_corr(df, list(pdf.columns))
    np.testing.assert_allclose(got, pdf.corr().to_numpy(), atol=1e-10)


def test_shifted_gram_is_stable_with_large_offset(spark, rng, monkeypatch):
    from stratum.operators import gram as G

    x = rng.normal(size=(2000, 3)) + np.array([1e9, -5e8, 3.0])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    monkeypatch.setattr(G, "NARROW_K", 1)
    g = G.gram(df, ["a", "b", "c"])
    np.testing.assert_allclose(g.cov(), np.cov(x - x.mean(0), rowvar=False), rtol=1e-6)


def test_grouped_wide_path_matches_narrow(spark, monkeypatch):
    from stratum.operators import gram as G

    df = panels.lineitem(spark, SF_SMALL).withColumn("g", (F.col("l_orderkey") % 4).cast("int"))
    narrow = G.gram(df, LI, by="g")
    monkeypatch.setattr(G, "NARROW_K", 1)
    wide = G.gram(df, LI, by="g")
    assert set(narrow) == set(wide)
    for key in narrow:
        np.testing.assert_allclose(wide[key].cross, narrow[key].cross, rtol=1e-8)
        np.testing.assert_allclose(wide[key].means, narrow[key].means, rtol=1e-10)
