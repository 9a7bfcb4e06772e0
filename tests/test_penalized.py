import numpy as np
import pytest

from stratum.operators import penalized as EN


@pytest.fixture
def data(rng):
    n = 400
    a, b = rng.integers(0, 6, n), rng.integers(0, 30, n)
    x = rng.normal(size=(n, 2)) * [1, 100] + [0, 1e5]
    y = 3 * x[:, 0] + 0.02 * x[:, 1] + (a == 2) * 4 - (b < 4) * 3 + rng.normal(size=n)
    return a, b, x, y


def frame(spark, a, b, x, y):
    rows = [(i, None if a[i] == 5 else f"a{a[i]}", int(b[i]), float(x[i, 0]), float(x[i, 1]), float(y[i])) for i in range(len(y))]
    return spark.createDataFrame([*rows, (9999, "a1", 1, None, 1.0, 1.0)], "id long, a string, b int, x double, z double, resid double")


def design(a, b, x):
    return np.concatenate([a[:, None] == np.arange(6), b[:, None] == np.arange(30), x], axis=1).astype(float)


def objective(X, y, b0, b, penalty, mix):
    s = X.std(axis=0) * b
    return ((y - b0 - X @ b) ** 2).mean() / 2 + penalty * (mix * np.abs(s).sum() + (1 - mix) / 2 * (s * s).sum())


@pytest.mark.parametrize("penalty,mix", [(0.05, 0.5), (0.3, 1.0), (0.3, 0.0), (5.0, 0.7)])
def test_optimal_on_the_dense_dummies(spark, rng, data, penalty, mix):
    a, b, x, y = data
    net = EN.elastic_net(frame(spark, *data), "resid", ["x", "z"], ["a", "b"], penalty=penalty, mix=mix)
    coef = np.array([net.levels["a"][v] for v in [*(f"a{i}" for i in range(5)), None]] + [net.levels["b"][i] for i in range(30)] + [net.numeric["x"], net.numeric["z"]])
    X = design(a, b, x)
    r, c, sd, _ = net.moments.standardized()
    assert EN.violation(r, c, penalty, mix, net.beta) <= 1e-8
    # conditions on the rows themselves
    z = (X - X.mean(axis=0)) / X.std(axis=0)
    e = y - net.intercept - X @ coef
    assert e.mean() == pytest.approx(0, abs=1e-7)
    g, s = z.T @ e / len(y), coef * X.std(axis=0)
    assert np.all(np.abs(g - penalty * (1 - mix) * s - penalty * mix * np.sign(s))[s != 0] < 1e-6)
    assert np.all(np.abs(g)[s == 0] <= penalty * mix + 1e-6)
    best = objective(X, y, net.intercept, coef, penalty, mix)
    assert all(objective(X, y, net.intercept, coef + rng.normal(size=len(coef)) * 1e-3 / X.std(axis=0), penalty, mix) > best for _ in range(20))


def test_penalty_by_folds_equals_plain_folds(spark, data):
    df = frame(spark, *data)
    net = EN.elastic_net(df, "resid", ["x", "z"], ["a", "b"], key=["id"], folds=4)
    from pyspark.sql import functions as F
    from stratum.functions.hashrand import uniform

    fold = {r.id: r.f for r in df.select("id", F.floor(uniform(43, "id") * 4).alias("f")).collect()}
    a, b, x, y = data
    X, f = design(a, b, x), np.array([fold[i] for i in range(len(y))])
    penalty, rmse = net.cv_rmse[25]
    total = 0.0
    for k in range(4):
        t = f != k
        whole = EN.Moments(t.sum(), np.append(X[t], y[t, None], axis=1).sum(axis=0), np.append(X[t], y[t, None], axis=1).T @ np.append(X[t], y[t, None], axis=1))
        b0, coef, _ = EN.path(whole, [penalty], 0.5)[-1]
        total += ((y[~t] - b0 - X[~t] @ coef) ** 2).sum()
    assert rmse == pytest.approx(np.sqrt(total / len(y)), rel=1e-5)
    assert net.penalty == min(net.cv_rmse, key=lambda e: e[1])[0]
    fitted = {r.id: r.fitted for r in net.effects(df.where("id < 9999")).collect()}
    assert np.corrcoef([fitted[i] for i in range(len(y))], y)[0, 1] > 0.9


def test_calibration_and_wrong_calls(spark, data):
    df = frame(spark, *data)
    out = EN.calibrated(df.where("id < 9999"), ["a", "b"], ["x", "z"], ["id"]).first()
    assert out.rmse_after < 0.7 * out.rmse_before and 40 < out.n < 120
    with pytest.raises(ValueError):
        EN.elastic_net(df, "resid", ["x"])
    with pytest.raises(ValueError):
        EN.elastic_net(df.where("false"), "resid", ["x"], penalty=1.0)
