"""Scalar functions, hash randomness and distribution tails."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.functions import hashrand as H
from stratum.functions import tails
from stratum.functions import transforms as T
from stratum.operators.terms import bspline_basis


def test_slug_pretty_and_headers():
    from stratum.sources.csv import normalize_name

    assert T.slug("  Life Expectancy (years) ") == "life_expectancy_years"
    assert T.pretty_name("under_five_deaths") == "Under Five Deaths"
    assert normalize_name(" Life expectancy ") == "life_expectancy"
    assert normalize_name("HIV/AIDS") == "hiv_aids"
    assert normalize_name("thinness  1-19 years") == "thinness_1_19_years"


def test_hash_uniform_matches_python_and_poisson_mean(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("k"))
    u = df.select("k", H.uniform(7, "k").alias("u")).toPandas()
    assert u["u"].between(0, 1).all()
    for k, v in u.head(20).itertuples(index=False):
        assert v == pytest.approx(H.uniform_py(7, k), abs=0)
    w = df.select(H.poisson1(3, "k").alias("w")).toPandas()["w"]
    assert w.mean() == pytest.approx(1.0, abs=0.03) and w.var() == pytest.approx(1.0, abs=0.06)


def test_tails_against_known_values():
    assert tails.norm_cdf(1.959963984540054) == pytest.approx(0.975, abs=1e-12)
    assert tails.norm_ppf(0.975) == pytest.approx(1.959963984540054, abs=1e-9)
    assert tails.t_sf2(2.0, 10) == pytest.approx(0.07338803477074, abs=1e-9)
    assert tails.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert tails.f_sf(4.964602743730711, 1, 10) == pytest.approx(0.05, abs=1e-8)
    assert tails.t_ppf(0.975, 30) == pytest.approx(2.042272456301238, abs=1e-7)


def test_bspline_partition_of_unity(spark):
    xs = np.linspace(0, 10, 41)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    basis = bspline_basis(F.col("x"), [2.5, 5.0, 7.5], 3, 0.0, 10.0)
    out = df.select(*[b.alias(f"b{i}") for i, b in enumerate(basis)]).toPandas().to_numpy()
    # the dropped first basis function is the complement of the kept ones
    first = 1.0 - out.sum(axis=1)
    assert (out >= -1e-12).all() and (first >= -1e-9).all()
    assert first[0] == pytest.approx(1.0) and first[-1] == pytest.approx(0.0, abs=1e-12)


def test_domain_index_and_sentinel(spark):
    df = spark.createDataFrame([(100.0,), (75000.0,), (0.0,), (None,)], "g double")
    got = [r[0] for r in df.select(T.domain_index(F.col("g"))).collect()]
    assert got[0] == pytest.approx(0.0) and got[1] == pytest.approx(1.0) and got[2] is None and got[3] is None
    s = [r[0] for r in df.select(T.sentinel_to_null(F.col("g"), 0.0)).collect()]
    assert s[2] is None and s[0] == 100.0
    assert math.isclose(T.log1p_under_coverage(F.lit(99.0)) is not None, True)


def test_unseen_levels_and_spline_bounds(spark):
    from stratum.operators import evaluate as E
    from stratum.operators import ols as L

    rows = [(float(i), "abc"[i % 3], float(i % 3 + 0.1 * i + (i * 7 % 5))) for i in range(60)]
    train = spark.createDataFrame(rows, "x double, g string, y double")
    other = spark.createDataFrame([*rows[:10], (3.0, "new", 1.0)], "x double, g string, y double")
    m = L.fit_ols(train, "y", ["x", "C(g)"])
    got = E.evaluate({"a model.with dots": m}, other).first()
    assert (got["model"], got["n"]) == ("a model.with dots", 10)  # the unseen level has no prediction
    far = spark.createDataFrame([(90.0, "a", 1.0)], "x double, g string, y double")
    with pytest.raises(Exception, match="outside the spline bounds"):
        E.evaluate({"s": L.fit_ols(train, "y", ["bs(x, df=4)"])}, far).collect()
    wide = L.fit_ols(train, "y", ["bs(x, df=4, lower_bound=-10, upper_bound=100.0)"])
    assert E.evaluate({"s": wide}, far).first()["n"] == 1


def test_grid_levels_are_the_callers_choice(spark):
    from stratum.operators import evaluate as E
    from stratum.operators import ols as L

    rows = [(float(i), ("a", "b", None)[i % 3], float(i), float(i % 7)) for i in range(90)]
    df = spark.createDataFrame(rows, "x double, g string, z double, y double")
    m = L.fit_ols(df, "y", ["x", "C(g)"])
    assert {r.g for r in E.interaction_grid(m, df, "x", "g", 3).collect()} == {"a", "b"}
    n = L.fit_ols(df, "y", ["x", "z"])
    with pytest.raises(ValueError):
        E.interaction_grid(n, df, "x", "z", 3)
    assert E.interaction_grid(n, df, "x", "z", 3, probs=(0.25, 0.75)).count() == 6
    assert E.interaction_grid(n, df, "x", "z", 3, levels=[1.0]).count() == 3


def test_trim_with_any_column_names(spark):
    from stratum.operators import diagnostics as D
    from stratum.operators import ols as L

    rows = [(float(i), 2.0 * i + (50.0 if i == 7 else i % 3), 0.0, 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, fitted double, cooks_d double")
    trimmed, kept = D.refit_without(L.fit_ols(df, "y", ["x"]), df)
    assert kept.columns == df.columns and kept.count() == trimmed.n < 40


def test_stream_of_a_folder_table(spark, tmp_path):
    from stratum.streaming.scoring import read_table_stream, run_to_parquet

    spark.range(100).selectExpr("id AS event_id", "id * 2.0D AS value").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    out = run_to_parquet(read_table_stream(spark, str(tmp_path), "events"), f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert out.count() == 100 and out.agg({"value": "sum"}).first()[0] == 9900.0


def test_a_set_checkpoint_folder_is_kept(spark):
    from stratum.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == before


def test_poisson_table_equals_the_column(spark):
    keys = ["", "1|1995", "12345678|1998", "å€|7", "x" * 50, "y" * 51, "z" * 300, None, *[f"{i}|{i % 7}" for i in range(200)]]
    seeds = [f"3:{r}" for r in (0, 7, 10, 99, 100, 199)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    want = rows.select("i", *[H.poisson1(s, F.col("k")).alias(f"s{j}") for j, s in enumerate(seeds)]).collect()
    got = H.poisson1_table(pa.array(keys), seeds)
    assert got.tolist() == [list(r[1:]) for r in sorted(want)]
    assert H.poisson1_table(pa.array([], pa.string()), seeds).shape == (0, 6)
