"""Centred merging at large means, and selection paths against plain refits."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import gram as G
from stratum.operators import ols as L
from stratum.operators import selection as S


def numpy_gram(x):
    c = x - x.mean(axis=0)
    return x.mean(axis=0), c.T @ c


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merge_and_difference_keep_digits(rng, offset):
    x = rng.normal(size=(5000, 3)) + offset
    parts = [G.Gram(("a", "b", "c"), len(p), *numpy_gram(p), len(p)) for p in (x[:1700], x[1700:])]
    whole = parts[0] + parts[1]
    mean, cross = numpy_gram(x)
    np.testing.assert_allclose(whole.cross, cross, rtol=1e-6, atol=1e-3 if offset else 1e-8)
    np.testing.assert_allclose((whole - parts[0]).cross, parts[1].cross, rtol=1e-6, atol=1e-3 if offset else 1e-8)
    states = [np.concatenate([[len(p), len(p)], numpy_gram(p)[0], numpy_gram(p)[1].ravel()]) for p in np.array_split(x, 7)]
    total = states[0]
    for s in states[1:]:
        total = G.merge_states(total, s, 3)
    np.testing.assert_allclose(total[5:].reshape(3, 3), cross, rtol=1e-6, atol=1e-3 if offset else 1e-8)


@pytest.mark.parametrize("k", [3, 8])
def test_gram_routes_agree_at_large_means(spark, rng, k):
    x = rng.normal(size=(3000, k)) + 1e9 * np.arange(1, k + 1)
    df = spark.createDataFrame([(int(i % 3), float(1 + i % 4), *map(float, r)) for i, r in enumerate(x)],
                               ["g", "w"] + [f"c{j}" for j in range(k)]).repartition(7)
    cols = [f"c{j}" for j in range(k)]
    mean, cross = numpy_gram(x)
    np.testing.assert_allclose(G.gram(df, cols).cross, cross, rtol=1e-5, atol=0.5)
    w = 1 + np.arange(len(x)) % 4
    m = (w[:, None] * x).sum(axis=0) / w.sum()
    wc = ((x - m) * w[:, None]).T @ (x - m)
    np.testing.assert_allclose(G.gram(df, cols, weight="w").cross, wc, rtol=1e-5, atol=1.0)
    for g, part in G.gram(df, cols, by="g", weight="w").items():
        assert part.rows == (np.arange(len(x)) % 3 == g).sum()


def test_cross_validation_at_large_means(spark):
    """y = 2 x on a column of epoch seconds: every fold must find the slope and no error."""
    df = spark.createDataFrame([(i, 1.6e9 + 86400.0 * i, 2.0 * (1.6e9 + 86400.0 * i) + 1000.0 * (i % 3 - 1)) for i in range(600)], "id long, x double, y double")
    for shuffle in (True, False):
        sel = S.Selector(df, "y", [], ["x"], cv_folds=5, key=["id"], shuffle=shuffle)
        assert len(sel.cv.folds) == 5 and sel.cv.total.n == 600
        assert all(abs(s - 1000 * math.sqrt(2 / 3)) < 100 for s in sel.cv.rmse_scores([0]))
        assert sel.fit(["x"]).model.coef[1] == pytest.approx(2.0, abs=1e-5)
    assert sorted(f.n for f in S.cv_grams(df.limit(8), ["x"], 3, 0, ["id"], shuffle=False).folds.values()) == [2, 3, 3]


def test_nan_counts_as_missing_for_any_number_of_columns(spark, rng):
    x = rng.normal(size=(200, 6))
    x[3, 0] = math.nan
    x[:, 5] = 7.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{j}" for j in range(6)])
    for k in (3, 6):
        cols = [f"c{j}" for j in range(k)]
        got = G.pairwise_corr(df, cols)
        ok = ~np.isnan(x[:, 0])
        assert got[0, 1] == pytest.approx(np.corrcoef(x[ok, 0], x[ok, 1])[0, 1], rel=1e-9)
        assert got[1, 2] == pytest.approx(np.corrcoef(x[:, 1], x[:, 2])[0, 1], rel=1e-9)
    assert np.isnan(got[5]).all()


def plain_path(df, target, base, cands, direction, criterion, threshold):
    """Every model of every round refitted by least squares."""
    n = len(df)
    y = df[target].to_numpy()

    def fit(cols):
        x = np.column_stack([np.ones(n)] + [df[c] for c in cols])
        b, *_ = np.linalg.lstsq(x, y, rcond=None)
        return float(((y - x @ b) ** 2).sum()), x.shape[1]

    full, p_full = fit([*base, *cands])

    def value(cols):
        rss, p = fit(cols)
        dev = n * (math.log(2 * math.pi) + math.log(rss / n) + 1)
        tss = float(((y - y.mean()) ** 2).sum())
        return {"aic": dev + 2 * p, "bic": dev + p * math.log(n), "aicc": dev + 2 * p + 2 * p * (p + 1) / (n - p - 1),
                "mdl": dev / 2 + 0.5 * p * math.log(n), "cp": rss / (full / (n - p_full)) + 2 * p - n,
                "adj_r2": -(1 - (n - 1) / (n - p) * rss / tss)}[criterion]

    now = [*base, *cands] if direction == "backward" else list(base)
    path = [list(now)]
    while True:
        moves = [[*now, c] for c in cands if c not in now] if direction != "backward" else []
        moves += [[t for t in now if t != c] for c in now if c not in base] if direction != "forward" else []
        if not moves:
            return path
        best = min(moves, key=value)
        if not value(best) < value(now) - threshold:
            return path
        now = best
        path.append(list(now))


def test_paths_equal_plain_refits(spark, rng):
    import pandas as pd

    n = 250
    x = rng.normal(size=(n, 6)) @ (np.eye(6) + 0.6 * rng.normal(size=(6, 6)))
    df = pd.DataFrame(x, columns=list("abcdef"))
    df["y"] = 2 * df.a - df.b + 0.2 * df.c + rng.normal(size=n)
    frame = spark.createDataFrame(df)
    sel = S.Selector(frame, "y", ["a"], list("bcdef"))
    for direction, criterion in itertools.product(S.DIRECTIONS, S.CRITERIA):
        threshold = 0.0005 if criterion == "adj_r2" else 0.05
        got = [s.terms for s in sel.path(direction, criterion, threshold).steps]
        assert got == plain_path(df, "y", ["a"], list("bcdef"), direction, criterion, threshold), (direction, criterion)
    whole = sel.path("forward", "aic", -math.inf)
    assert [len(s.terms) for s in whole.steps] == [1, 2, 3, 4, 5, 6]
    assert len(sel.path("forward", "aic", -math.inf, max_models=10).steps) == 3  # 1 + 5 + 4 models
    for bad in ({"direction": "up"}, {"criterion": "r"}, {"max_models": 0}, {"direction": "stepwise", "threshold": -math.inf}):
        with pytest.raises(ValueError):
            sel.path(**bad)


def test_collinear_terms(spark, rng):
    x = rng.normal(size=(120, 2))
    rows = [(float(a), float(b), float(a + b), float(3 * a - b + e)) for (a, b), e in zip(x, rng.normal(size=120))]
    sel = S.Selector(spark.createDataFrame(rows, "a double, b double, c double, y double"), "y", [], ["a", "b", "c"])
    for direction in S.DIRECTIONS:
        best = sel.path(direction, "aic", 0.0).best
        assert len(best.terms) == 2
        assert best.metrics["rss"] == pytest.approx(L.fit_ols(spark.createDataFrame(rows, "a double, b double, c double, y double"), "y", ["a", "b"]).rss, rel=1e-9)


def test_screen_reports_holdout_change(spark, rng):
    x = rng.normal(size=(300, 2))
    rows = [(i, float(a), float(b), float(a + b + 2 * a * b + e)) for i, ((a, b), e) in enumerate(zip(x, rng.normal(size=300)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    train, test = df.where(F.col("id") < 200), df.where(F.col("id") >= 200)
    out = S.Selector(train, "y", ["a", "b"], []).interaction_screen(["a", "b"], [("a", "b")], train, holdout=test)[0]
    t = test.toPandas()
    err = lambda m, cols: math.sqrt(np.mean((t.y - m.coef[0] - np.column_stack(cols) @ m.coef[1:]) ** 2))
    want = err(L.fit_ols(train, "y", ["a", "b", "a:b"]), [t.a, t.b, t.a * t.b]) - err(L.fit_ols(train, "y", ["a", "b"]), [t.a, t.b])
    assert out["delta_holdout_rmse"] == pytest.approx(want, rel=1e-9)
