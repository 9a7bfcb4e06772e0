"""PCA (PCA1-PCA5) and grouped PCA / feature groups (GRP1-GRP8): invariants from the reference tests."""

import numpy as np
import pandas as pd
import pytest

from stratum.operators import groups as G
from stratum.operators import pca as P


@pytest.fixture
def pca_frame(spark, rng):
    c1, c2, c3 = rng.normal(0, 3, 100), rng.normal(0, 1, 100), rng.normal(0, 0.5, 100)
    pdf = pd.DataFrame({"feature1": c1 + 0.5 * c2, "feature2": c1 - 0.5 * c2, "feature3": c2 + 0.3 * c3,
                        "feature4": c3})
    return spark.createDataFrame(pdf), pdf


def test_pca_matches_numpy(spark, pca_frame):
    df, pdf = pca_frame
    m = P.fit_pca(df)
    vals = np.sort(np.linalg.eigvalsh(np.cov(pdf.to_numpy(), rowvar=False)))[::-1]
    np.testing.assert_allclose(m.variances, vals, rtol=1e-9, atol=1e-10)
    assert np.all(np.diff(m.variances) <= 1e-12)
    np.testing.assert_allclose(np.linalg.norm(m.components, axis=0), 1.0)
    ev = m.explained_variance(spark).toPandas()
    assert ev["cumulative_ratio"].iloc[-1] == pytest.approx(1.0)
    assert ((ev["explained_ratio"] >= 0) & (ev["explained_ratio"] <= 1)).all()


def test_scores_variance_equals_eigenvalue(spark, pca_frame):
    df, _ = pca_frame
    m = P.fit_pca(df, n_components=2)
    s = m.transform(df).toPandas()
    np.testing.assert_allclose(s.var(ddof=1).to_numpy(), m.variances, rtol=1e-9, atol=1e-10)
    np.testing.assert_allclose(s.mean().to_numpy(), 0.0, atol=1e-9)


def test_feature_ranking_methods(spark, pca_frame):
    df, _ = pca_frame
    m = P.fit_pca(df)
    assert m.feature_ranking(spark, 2, "max").count() == 4
    with pytest.raises(ValueError):
        m.feature_ranking(spark, 2, "nope")


@pytest.fixture
def group_frame(spark, rng):
    b1, b2 = rng.normal(size=100), rng.normal(size=100)
    pdf = pd.DataFrame({"feat1a": b1 + 0.1 * rng.normal(size=100), "feat1b": b1 + 0.1 * rng.normal(size=100),
                        "feat1c": b1 + 0.1 * rng.normal(size=100), "feat2a": b2 + 0.3 * rng.normal(size=100),
                        "feat2b": b2 + 0.3 * rng.normal(size=100)})
    return spark.createDataFrame(pdf)


GROUPS = [G.FeatureGroup("Group1", ("feat1a", "feat1b", "feat1c")), G.FeatureGroup("Group2", ("feat2a", "feat2b"))]


def test_grouped_pca(spark, group_frame):
    m = G.fit_grouped_pca(group_frame, GROUPS, threshold=0.8)
    g1 = m.models["Group1"]
    assert g1.variances[0] / g1.total_variance > 0.8
    assert m.n_keep["Group1"] == 1
    np.testing.assert_allclose(np.linalg.norm(g1.components, axis=0), 1.0)
    out = m.transform(group_frame)
    assert set(out.columns) == {"Group1_PC1", "Group2_PC1"}
    s = m.summary()
    assert s["n_features_before"] == 5 and s["n_features_after"] == 2
    # PC1 of a group equals a direct PCA on the same columns up to sign
    direct = P.fit_pca(group_frame, ["feat1a", "feat1b", "feat1c"])
    np.testing.assert_allclose(np.abs(direct.components[:, 0]), np.abs(g1.components[:, 0]), atol=1e-10)


def test_grouped_pca_validation(spark, group_frame):
    with pytest.raises(ValueError):
        G.fit_grouped_pca(group_frame, [])
    with pytest.raises(ValueError):
        G.fit_grouped_pca(group_frame, GROUPS, threshold=1.5)
    with pytest.raises(ValueError):
        G.fit_grouped_pca(group_frame, [G.FeatureGroup("e", ())])
    with pytest.raises(KeyError):
        G.fit_grouped_pca(group_frame, [G.FeatureGroup("x", ("nope",))])
    m = G.fit_grouped_pca(group_frame, GROUPS)
    with pytest.raises(KeyError):
        m.transform(group_frame.drop("feat2b"))


def test_threshold_one_keeps_all(spark, group_frame):
    m = G.fit_grouped_pca(group_frame, GROUPS, threshold=1.0)
    assert m.n_keep["Group1"] == 3  # R12: rounding never collapses to one component


def test_combine_and_suggest(spark, group_frame):
    cm = G.fit_combine(group_frame, ["feat1a", "feat1b", "feat1c"], "g1", standardize=True)
    assert sum(cm.weights) == pytest.approx(1.0)
    out = cm.transform(group_frame)
    assert "g1" in out.columns and "feat1a" not in out.columns
    groups, summary = G.suggest_groups(group_frame, group_frame.columns, threshold=0.7)
    assert sorted(map(sorted, groups.values())) == [["feat1a", "feat1b", "feat1c"], ["feat2a", "feat2b"]]
    assert summary.count() == 2


def test_supervised_pca(spark, group_frame):
    from pyspark.sql import functions as F

    df = group_frame.withColumn("y", F.col("feat1a") * 2 + F.col("feat2a"))
    kept, pca, model = G.supervised_pca(df, ["feat1a", "feat1b", "feat1c", "feat2a", "feat2b"], "y", threshold=0.95)
    assert "feat1a" in kept
    assert model.metrics()["r2"] > 0.8


def test_grouped_summary_table(spark, group_frame):
    m = G.fit_grouped_pca(group_frame, GROUPS, threshold=0.8)
    rows = {r["group"]: r for r in m.summary_table(spark).collect()}
    old = m.summary()
    assert set(rows) == {g.name for g in GROUPS} | {"all"}
    assert (rows["all"].n_features, rows["all"].n_axes) == (old["n_features_before"], old["n_features_after"])
    assert rows["all"].explained == pytest.approx(old["mean_explained_variance"]) and rows["all"].first_axis == pytest.approx(old["mean_pc1_ratio"])
    for g in GROUPS:
        x = np.array(group_frame.select(*g.features).dropna().collect(), dtype=float)
        v = np.linalg.eigvalsh(np.cov(x.T))[::-1]
        assert rows[g.name].explained == pytest.approx(v[:rows[g.name].n_axes].sum() / v.sum(), rel=1e-8)
