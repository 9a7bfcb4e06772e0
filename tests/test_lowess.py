import numpy as np
import pytest

from stratum.operators import lowess as LW


def plain(x, y, frac):
    """Every row against its k nearest, weight by weight."""
    n = len(x)
    k = min(n, max(2, int(frac * n + 1e-10)))
    out = []
    for x0 in x:
        d = np.abs(x - x0)
        h = np.sort(d)[k - 1]
        if h == 0:
            out.append(y[d == 0].mean())
            continue
        w = np.clip(1 - (d / h) ** 3, 0, None) ** 3
        e = (x - x0) / h
        s = w.sum() * (w * e * e).sum() - (w * e).sum() ** 2
        flat = s <= 1e-12 * w.sum() * (w * e * e).sum()
        out.append((w * y).sum() / w.sum() if flat else ((w * e * e).sum() * (w * y).sum() - (w * e).sum() * (w * e * y).sum()) / s)
    return np.array(out)


CASES = {
    "uniform": lambda r, n: r.uniform(0, 10, n),
    "far from zero": lambda r, n: 1.7e9 + r.uniform(0, 50, n),
    "heavy tail": lambda r, n: r.standard_cauchy(n),
    "ties": lambda r, n: r.integers(0, 12, n).astype(float),
    "one value in most rows": lambda r, n: np.where(r.random(n) < 0.7, 3.0, r.normal(size=n)),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("frac,size", [(0.3, 64), (2 / 3, 100), (0.05, 256)])
def test_equals_plain_lowess(spark, name, frac, size):
    rng = np.random.default_rng(7)
    n = 700
    x = CASES[name](rng, n)
    y = np.sin(x - np.median(x)) + rng.normal(size=n) + 5
    got = LW.lowess(spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "x long, idx double, y double"), "idx", "y", frac, keep=("x",), size=size)
    assert got.columns == ["x", "idx", "y", "fitted"]
    rows = sorted(got.collect())
    assert [r.x for r in rows] == list(range(n))
    assert np.array([r.fitted for r in rows]) == pytest.approx(plain(x, y, frac), rel=1e-8, abs=1e-8)


def test_two_thousand_rows_at_default_blocks(spark):
    rng = np.random.default_rng(8)
    x = np.exp(rng.normal(size=2000) * 2)
    y = np.log(x) + rng.normal(size=2000)
    got = LW.lowess(spark.createDataFrame(zip(x.tolist(), y.tolist()), "a double, b double"), "a", "b", 0.3).toPandas()
    order, mine = np.argsort(x), np.argsort(got["a"].to_numpy())
    assert got["fitted"].to_numpy()[mine] == pytest.approx(plain(x, y, 0.3)[order], rel=1e-9, abs=1e-9)


def test_nulls_and_few_rows(spark):
    schema = "a double, b double"
    assert LW.lowess(spark.createDataFrame([(None, 1.0), (2.0, None)], schema), "a", "b").count() == 0
    assert [tuple(r) for r in LW.lowess(spark.createDataFrame([(1.0, 4.0), (None, 1.0)], schema), "a", "b").collect()] == [(1.0, 4.0, 4.0)]
    two = LW.lowess(spark.createDataFrame([(1.0, 4.0), (2.0, 6.0)], schema), "a", "b").collect()
    assert sorted(tuple(r) for r in two) == [(1.0, 4.0, 4.0), (2.0, 6.0, 6.0)]


def test_a_fit_adds_blocks_in_few_passes():
    rng = np.random.default_rng(9)
    x, y = rng.normal(size=64), rng.normal(size=64)
    top = LW._tree(LW._rows_as_blocks(np.sort(x), y))[-1]
    x0, h = np.array([1.5, -2.0, 3.0]), np.array([6.0, 7.0, 8.0])
    sums = np.zeros((3, 5))
    LW._add(sums, top, np.zeros(3, dtype=int), np.arange(3), x0, h, 1)
    e = (np.sort(x) - x0[:, None]) / h[:, None]
    w = (1 - e**3) ** 3
    want = np.stack([w.sum(1), (w * e).sum(1), (w * e * e).sum(1), (w * y).sum(1), (w * e * y).sum(1)], axis=1)
    assert sums == pytest.approx(want, rel=1e-10)
    assert LW._powers(h, 4).tolist() == [[1.0] * 3, h.tolist(), (h * h).tolist(), (h * h * h).tolist()]
