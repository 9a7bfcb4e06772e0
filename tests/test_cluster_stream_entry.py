"""Clustering quality against brute force, streaming scoring, and the driver contract."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum.operators import cluster as CL


def test_silhouette_sq_brute_force(spark, rng):
    x = np.vstack([rng.normal(0, 1, (20, 3)), rng.normal(5, 1, (15, 3)), rng.normal(-5, 1, (1, 3))])
    lab = np.array([0] * 20 + [1] * 15 + [2])
    df = spark.createDataFrame([(i, int(l), *map(float, v)) for i, (l, v) in enumerate(zip(lab, x))],
                               "id int, c int, a double, b double, d double")
    got = CL.silhouette_sq(df, ["a", "b", "d"], "c", keep=["id"]).toPandas().sort_values("id")["silhouette_sq"]
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    ref = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            ref.append(0.0)
            continue
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == k].mean() for k in set(lab) if k != lab[i])
        ref.append((b - a) / max(a, b))
    np.testing.assert_allclose(got.to_numpy(), ref, rtol=1e-9, atol=1e-12)


def test_rand_index_brute_force(spark, rng):
    a, b = rng.integers(0, 3, 60), rng.integers(0, 4, 60)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a int, b int")
    same_a = a[:, None] == a[None, :]
    same_b = b[:, None] == b[None, :]
    iu = np.triu_indices(60, 1)
    ref = np.mean(same_a[iu] == same_b[iu])
    assert CL.rand_index(df, "a", "b") == pytest.approx(ref)


def test_lloyd_and_hierarchical(spark, rng):
    x = np.vstack([rng.normal(0, 0.3, (30, 2)), rng.normal(4, 0.3, (30, 2))])
    df = spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(x)], "id int, p double, q double")
    centers, lab = CL.lloyd(df, ["p", "q"], np.array([[0.0, 0.0], [4.0, 4.0]]), 3)
    assert lab.groupBy("cluster").count().count() == 2
    h = CL.hierarchical(df, ["p", "q"], k=2, keep=["id"])
    sizes = sorted(r["count"] for r in h.groupBy("cluster").count().collect())
    assert sizes == [30, 30]


def test_streaming_scoring(spark, tmp_path):
    from stratum.operators import outliers as O
    from stratum.operators import scale as S
    from stratum.sources.tables import table
    from stratum.streaming.scoring import read_table_stream, score_stream

    ev = table(spark, SF_SMALL, "events")
    scaler = S.fit_scaler(ev, ["value"])
    fences = O.zscore_fences(ev, ["value"], 3.0)
    stream = read_table_stream(spark, SF_SMALL, "events")
    out = score_stream(stream, keep=["event_id"], scaler=scaler, fences=fences)
    q = (out.writeStream.format("memory").queryName("scored_events").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination(120)
    res = spark.sql("SELECT * FROM scored_events")
    assert res.count() == ev.count()
    batch = score_stream(ev, keep=["event_id"], scaler=scaler, fences=fences)
    assert res.filter("value_outlier").count() == batch.filter("value_outlier").count()


def test_sources_conform(spark, tmp_path):
    from stratum.sources import csv as SC

    p = tmp_path / "panel.csv"
    p.write_text("Country,Year,Status,Life expectancy ,GDP, BMI ,Adult Mortality\n"
                 "A,2015,Developed,80.5,1000,20.1,50\nB,2015,Developing,,abc,18.0,120\n"
                 "C,2015, developed ,75.0,500,22.0,80\n")
    df = SC.read_panel(spark, str(p))
    assert df.columns[:3] == ["country", "year", "year_ts"]
    assert "life_expectancy" in df.columns and "adult_mortality" in df.columns
    rows = {r["country"]: r for r in df.collect()}
    assert set(rows) == {"A", "C"}  # missing target dropped
    assert rows["A"]["status"] == 1 and rows["C"]["status"] == 1 and rows["A"]["year"] == 2015
    q = tmp_path / "milk.csv"
    q.write_text('"name";"water";"fat"\n"cow";"87,5";"3,9"\n"goat";"87,0";"bad"\n')
    m = SC.read_semicolon_comma_decimal(spark, str(q), ["water", "fat"]).collect()
    assert m[0]["water"] == 87.5 and m[1]["fat"] is None
    w = tmp_path / "wide.csv"
    w.write_text("iso3,country,hdi_2010,hdi_f_2010,hdi_rank_2010,hdi_2011\nAAA,A,0.5,0.4,3,0.6\n")
    wide = SC.read_wide_series(spark, str(w), ["hdi", "hdi_f", "hdi_rank"], years=[2010])
    assert set(wide.columns) == {"iso3", "country", "hdi_2010", "hdi_f_2010", "hdi_rank_2010"}
    from stratum.operators.reshape import wide_to_long

    long = wide_to_long(wide, ["iso3", "country"]).collect()
    assert {r["series"] for r in long} == {"hdi", "hdi_f", "hdi_rank"}


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() >= 0 and df.columns
    qs, orc = e.queries(), e.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 100


def test_roles_and_view(spark):
    from stratum.roles import Roles, make_view

    rows = [("A", 2015, 1, 80.0, 1000.0, 20.0), ("B", 2015, 0, 70.0, None, 18.0), ("C", 2015, 1, 75.0, 500.0, 22.0)]
    df = spark.createDataFrame(rows, "country string, year int, status int, life_expectancy double, gdp double, "
                                     "bmi double")
    roles = Roles(target="life_expectancy", status="status", labels={"gdp": "GDP per capita"})
    assert roles.feature_columns(df) == ["gdp", "bmi"]
    v = make_view(df, roles, standardized=True)
    assert v.is_standardized and v.target == "life_expectancy"
    assert v.features == ["gdp", "bmi"] and v.labels["bmi"] == "Bmi" and v.labels["gdp"] == "GDP per capita"
    assert v.df.count() == 2  # incomplete row dropped after whole-frame scaling
    with pytest.raises(KeyError):
        make_view(df.drop("life_expectancy"), roles)


def test_lowess_linear_and_bootstrap_ci(spark, rng):
    from stratum.operators import evaluate as E
    from stratum.operators import ols as L
    from stratum.operators.smooth import binned_lowess

    x = rng.uniform(0, 10, 2000)
    y = 3.0 + 2.0 * x + rng.normal(0, 0.5, 2000)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))],
                               "id int, x double, y double")
    curve = binned_lowess(df, "x", "y", frac=0.3, bins=20).toPandas()
    np.testing.assert_allclose(curve["fitted"], 3.0 + 2.0 * curve["x_center"], atol=0.3)
    m = L.fit_ols(df, "y", ["x"])
    ci = E.bootstrap_metrics(m, df, ["id"], n_boot=30, seed=1).toPandas().set_index("metric")
    rmse = m.metrics()["rmse"]
    assert ci.loc["rmse", "ci_low"] <= rmse <= ci.loc["rmse", "ci_high"]
    band = E.confidence_band(m, spark, "x", 0.0, 10.0, {}, n_points=5).toPandas()
    assert ((band["lower"] < band["fit"]) & (band["fit"] < band["upper"])).all()


def test_spectral_follows_the_neighbour_graph(spark, rng):
    """Two groups of different size and spread, all rows on the graph; and the graph holds true neighbours."""
    x = np.vstack([rng.normal(0, 0.4, (70, 2)), rng.normal(0, 1.0, (140, 2)) + [7.0, 0.0]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id int, p double, q double")
    lab = CL.spectral(df, ["p", "q"], k=2, n_neighbors=20, reach=30, seed=0, keep=["id"]).toPandas()
    group = (lab["id"] >= 70).astype(int)
    assert len(lab) == 210
    assert max((lab["cluster"] == group).mean(), (lab["cluster"] != group).mean()) > 0.95
    points = df.selectExpr("cast(id AS long) AS id", "array(p, q) AS x")
    edges = CL.neighbour_edges(points, 2, 5, 8, 16, 0).toPandas()
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    true = {(i, j) for i in range(210) for j in np.argsort(d2[i])[1:6]}
    assert len(true & set(zip(edges.src, edges.dst))) > 0.9 * len(true)
    assert edges.groupby("src").size().max() <= 5
