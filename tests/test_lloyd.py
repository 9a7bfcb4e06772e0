import numpy as np
import pytest

from stratum.operators import lloyd as KM


def plain_lloyd(x, centers):
    centers = np.array(centers, dtype=float)
    while True:
        d = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        new = np.array([x[own == j].mean(axis=0) if (own == j).any() else c for j, c in enumerate(centers)])
        if np.abs(new - centers).max() < 1e-12:
            return new, own, d.min(axis=1).sum()
        centers = new


def plain_silhouette(x, own):
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    out = []
    for i in range(len(x)):
        mine = own == own[i]
        a = d[i, mine].sum() / max(1, mine.sum() - 1)
        b = min(d[i, own == c].mean() for c in set(own) - {own[i]})
        out.append(0.0 if mine.sum() == 1 or max(a, b) == 0 else (b - a) / max(a, b))
    return np.mean(out)


@pytest.fixture
def blobs(spark, rng):
    x = np.concatenate([rng.normal(c, 1, (120, 3)) for c in (0, 4, 9)]) + 1e6
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    return x, df


def test_fits_of_all_sizes_together_equal_plain_lloyd(spark, blobs, rng):
    x, df = blobs
    starts = [x[rng.choice(len(x), k, replace=False)] for k in (1, 2, 3, 5, 3)]
    points = KM.as_points(df, ["a", "b", "c"])
    fits = KM.fit_many(points, starts)
    for start, fit in zip(starts, fits):
        centers, own, inertia = plain_lloyd(x, start)
        assert fit.converged and fit.centers == pytest.approx(centers, abs=1e-6)
        assert fit.inertia == pytest.approx(inertia, rel=1e-9)
        assert fit.sizes.tolist() == np.bincount(own, minlength=fit.k).tolist()
    means = KM.silhouettes(points, fits[1:])
    assert means == pytest.approx([plain_silhouette(x, plain_lloyd(x, s)[1]) for s in starts[1:]], abs=1e-6)


def test_best_of_starts_and_curves(spark, blobs):
    x, df = blobs
    _, best = KM.best_by_k(df, ["a", "b", "c"], ["id"], [2, 3, 400], n_init=4)
    assert set(best) == {2, 3}  # 400 centres need 400 rows
    starts = KM.hashed_starts(df, ["a", "b", "c"], ["id"], 3, 4)
    assert best[3].inertia == pytest.approx(min(plain_lloyd(x, s)[2] for s in starts), rel=1e-9)
    assert [r.k for r in KM.elbow(df, ["a", "b", "c"], ["id"], [2, 3]).collect()] == [2, 3]


def test_empty_clusters_nulls_and_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [None, 1.0])], "id long, v array<double>")
    points = KM.as_points(df, "v", keep=["id"])
    assert sorted(r.id for r in points.collect()) == [1, 2]
    fit = KM.fit_many(points, [np.array([[0.0, 0.5], [50.0, 50.0]])])[0]
    assert fit.centers.tolist() == [[0.0, 0.5], [50.0, 50.0]] and fit.sizes.tolist() == [2, 0]
    assert KM.silhouettes(points, [fit]) == [0.0]
    assert {r.id: r.cluster for r in KM.assign(points, fit.centers, keep=["id"]).collect()} == {1: 0, 2: 0}
    assert KM.fit_many(points.where("false"), [np.zeros((2, 2))])[0].sizes.tolist() == [0, 0]
    with pytest.raises(ValueError):
        KM.as_points(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"), "v")


def test_sums_of_a_round_hold_for_ties_and_far_from_zero():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(500, 3)), 1) + 1e6
    fits = [np.concatenate([x[:k], x[:1]]) for k in (1, 4, 6)]  # the last centre ties with the first
    for centers, got in zip(fits, KM._sums(x, fits)):
        d = ((x[:, None] - centers) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        for i, c in enumerate(centers):
            rows = own == i
            want = [rows.sum(), d[rows, i].sum(), *(x[rows] - c).sum(axis=0)]
            assert got[i] == pytest.approx(want, abs=1e-6)


def test_rounds_read_blocks_of_rows(spark, rng):
    x = rng.normal(size=(KM._ROWS + 100, 2))
    points = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").coalesce(1)
    blocks = KM._packed(points, 2)
    assert blocks.count() <= 4
    got = np.concatenate([np.frombuffer(r.block).reshape(-1, 2) for r in blocks.collect()])
    assert sorted(map(tuple, got)) == sorted(map(tuple, x))


def test_starts_that_lie_together_converge_too(spark, rng):
    # the starts differ in the last digits only, which no centre comes nearer to than by rounding
    x = np.concatenate([0.3 * (1 + np.finfo(float).eps * rng.integers(-2, 3, size=(300, 2))), 0.3 + rng.normal(size=(9, 2))])
    points = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    fit = KM.fit_many(points, [x[[0, 1, 2]]], max_rounds=40)[0]
    assert fit.converged and fit.rounds < 30
