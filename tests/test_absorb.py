import numpy as np
import pytest

from stratum.operators import absorb as AB


def dummies(x, y, levels):
    """OLS with a dummy a level: coefficients and standard errors of ``x``."""
    x, y = x - x.mean(axis=0), y - y.mean()
    blocks = [x] + [(np.array(lv)[:, None] == np.unique(lv)[None]).astype(float) for lv in levels]
    full = np.concatenate(blocks, axis=1)
    q = np.linalg.pinv(full.T @ full, rcond=1e-12)
    beta = q @ full.T @ y
    rss = ((y - full @ beta) ** 2).sum()
    df = len(y) - np.linalg.matrix_rank(full)
    return beta[:x.shape[1]], np.sqrt(np.diag(q)[:x.shape[1]] * rss / df)


def table(spark, x, y, a, b):
    rows = [(float(x0), float(x1), float(t), f"a{i}", int(j)) for (x0, x1), t, i, j in zip(x, y, a, b)]
    rows += [(None, 1.0, 1.0, "a1", 1), (1.0, 1.0, 1.0, None, 2), (1.0, 1.0, None, "a1", 2)]
    return spark.createDataFrame(rows, "x double, z double, y double, a string, b int")


@pytest.fixture
def data(rng):
    n = 300
    a, b = rng.integers(0, 40, n), rng.integers(0, 7, n)
    a[:100] = 3  # a hot level
    x = rng.normal(size=(n, 2)) + a[:, None] * 0.3 + 1e4
    return x, 2 * x[:, 0] - x[:, 1] + a + b * 5 + rng.normal(size=n), a, b


def check(model, x, y, levels):
    coef, err = dummies(x, y, levels)
    assert model.coef == pytest.approx(coef, rel=1e-6)
    assert np.sqrt(np.diag(model.cov_params)) == pytest.approx(err, rel=1e-6)


def test_one_category_equals_the_dummy_fit(spark, data):
    x, y, a, b = data
    check(AB.fit_absorbed(table(spark, x, y, a, b), "y", ["x", "z"], "a"), x, y, [a])


def test_two_categories_equal_the_dummy_fit(spark, data):
    x, y, a, b = data
    check(AB.fit_absorbed(table(spark, x, y, a, b), "y", ["x", "z"], ["a", "b"]), x, y, [a, b])


def test_categories_in_two_connected_parts(spark, rng):
    a = rng.integers(0, 6, 120)
    b = np.where(a < 3, rng.integers(0, 2, 120), rng.integers(2, 5, 120))
    x = rng.normal(size=(120, 2))
    y = x[:, 0] + a - b + rng.normal(size=120)
    check(AB.fit_absorbed(table(spark, x, y, a, b), "y", ["x", "z"], ["a", "b"]), x, y, [a, b])


def test_wrong_calls(spark, data):
    df = table(spark, *data)
    with pytest.raises(ValueError):
        AB.fit_absorbed(df, "y", ["x"], ["a", "b", "z"])
    with pytest.raises(ValueError):
        AB.fit_absorbed(df.where("false"), "y", ["x"], "a")
