import numpy as np
import pytest

from stratum.operators import lloyd as KM
from stratum.operators import mixture as MX
from stratum.operators import ward as WD


def plain_ward(x):
    """Closest pair by closest pair: heights and the partition at each number of clusters."""
    groups = [[i] for i in range(len(x))]
    heights, cuts = [], {len(x): [g[:] for g in groups]}
    while len(groups) > 1:
        best = None
        for a in range(len(groups)):
            for b in range(a + 1, len(groups)):
                na, nb = len(groups[a]), len(groups[b])
                d = x[groups[a]].mean(axis=0) - x[groups[b]].mean(axis=0)
                cost = na * nb / (na + nb) * (d @ d)
                if best is None or cost < best[0]:
                    best = cost, a, b
        cost, a, b = best
        groups[a] = groups[a] + groups.pop(b)
        heights.append(np.sqrt(2 * cost))
        cuts[len(groups)] = [sorted(g) for g in groups]
    return heights, cuts


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double")


def test_tree_equals_plain_ward_row_by_row(spark, rng):
    x = rng.normal(size=(90, 2)) * [1, 5] + 1e5
    heights, cuts = plain_ward(x)
    points, tree = WD.ward(frame(spark, x).repartition(7), ["a", "b"], keep=["id"])
    assert [m[2] for m in tree.merges] == pytest.approx(heights, rel=1e-6) and tree.loss == 0
    for k in (1, 2, 5, 40, 90):
        found = {}
        for r in tree.assign(points, k, keep=["id"]).collect():
            found.setdefault(r.cluster, []).append(r.id)
        assert sorted(sorted(v) for v in found.values()) == sorted(sorted(v) for v in cuts[k])
        sizes = [len(found[c]) for c in sorted(found)]
        assert sizes == sorted(sizes, reverse=True)
    table = tree.merge_table(spark).collect()
    assert len(table) == 89 and table[-1].n_rows == 90


def test_compressed_features_keep_sums_and_find_blobs(spark, rng):
    x = np.concatenate([rng.normal(c, 0.5, (400, 2)) for c in ((0, 0), (6, 0), (0, 7))])
    truth = np.repeat([0, 1, 2], 400)
    points, tree = WD.ward(frame(spark, x).repartition(9), ["a", "b"], keep=["id"], entries=32)
    assert len(tree.n) <= 32 and tree.n.sum() == 1200
    total = ((x - x.mean(axis=0)) ** 2).sum()
    assert tree.q.sum() + sum(h * h / 2 for _, _, h, _ in tree.merges) == pytest.approx(total, rel=1e-9)
    assert 0 < tree.loss < 0.05
    found = np.array([r.cluster for r in sorted(tree.assign(points, 3, keep=["id"]).collect())])
    assert all(len(set(found[truth == t])) == 1 for t in range(3)) and len(set(found)) == 3


def test_ties_nulls_and_empty_tables(spark):
    schema = "id long, a double, b double"
    df = spark.createDataFrame([(i, float(i % 2), 0.0) for i in range(20)] + [(99, None, 1.0)], schema)
    points, tree = WD.ward(df, ["a", "b"], keep=["id"])
    assert sum(m[2] == 0 for m in tree.merges) == 18
    assert {(r.id % 2, r.cluster) for r in tree.assign(points, 2, keep=["id"]).collect()} in ({(0, 0), (1, 1)}, {(0, 1), (1, 0)})
    points, tree = WD.ward(df.where("false"), ["a", "b"])
    assert tree.merges == [] and tree.assign(points, 2).count() == 0


def plain_em(x, w, m, s, tol):
    path = []
    while True:
        d = np.stack([np.log(wc) - 0.5 * np.log(np.linalg.det(2 * np.pi * sc)) - 0.5 * np.einsum("ij,jk,ik->i", x - mc, np.linalg.inv(sc), x - mc)
                      for wc, mc, sc in zip(w, m, s)], axis=1)
        top = d.max(axis=1)
        ll = top + np.log(np.exp(d - top[:, None]).sum(axis=1))
        path.append(ll.mean())
        if len(path) > 1 and path[-1] - path[-2] <= tol:
            return w, m, s, path
        r = np.exp(d - ll[:, None])
        w = r.mean(axis=0)
        m = [(r[:, c:c + 1] * x).sum(axis=0) / r[:, c].sum() for c in range(len(w))]
        s = [np.einsum("i,ij,ik->jk", r[:, c], x - m[c], x - m[c]) / r[:, c].sum() + MX.REG * np.eye(x.shape[1]) for c in range(len(w))]


def test_mixtures_equal_plain_em_and_likelihood_never_falls(spark, rng):
    x = np.concatenate([rng.multivariate_normal((0, 0), [[1, 0.6], [0.6, 1]], 300), rng.multivariate_normal((5, 2), [[2, -0.5], [-0.5, 0.5]], 200)]) + 1e4
    points = KM.as_points(frame(spark, x), ["a", "b"], keep=["id"])
    spread = np.cov(x.T)
    starts = [MX.Mixture(np.array([0.5, 0.5]), x[[3, 400]].copy(), np.array([spread, spread])),
              MX.Mixture(np.full(3, 1 / 3), x[[1, 2, 3]].copy(), np.array([spread] * 3))]
    held = MX.fit_mixtures(points, starts, tol=1e-5)
    for start, got in zip(starts, held):
        w, m, s, path = plain_em(x, start.weights, start.means, start.covs, 1e-5)
        assert got.converged and np.all(np.diff(got.path) >= -1e-9)
        assert len(got.path) == len(path)
        assert got.path == pytest.approx(path, rel=1e-8)
        assert got.weights == pytest.approx(w, rel=1e-5) and got.means == pytest.approx(np.array(m), rel=1e-8)
        assert got.covs == pytest.approx(np.array(s), rel=1e-4, abs=1e-4)
    own = np.array([r.cluster for r in sorted(MX.assign(points, held[0], keep=["id"]).collect())])
    assert np.mean(own == np.repeat([0, 1], [300, 200])) > 0.97
    best = MX.best_mixture(points, KM.fit_many(points, [x[[3, 400]], x[[1, 2]]]), tol=1e-4)
    assert best.path[-1] >= held[0].path[-1] - 1e-2
    assert MX.fit_mixtures(points.where("false"), starts[:1])[0].path == []


def test_compression_holds_strips_and_no_matrix_of_all_pairs(rng):
    import tracemalloc

    n, c = rng.integers(1, 4, 1500).astype(float), np.round(rng.normal(size=(1500, 3)), 1)  # with ties
    d = ((c[:, None] - c) ** 2).sum(axis=2) * (n[:, None] * n / (n[:, None] + n))
    np.fill_diagonal(d, np.inf)
    near, cost = WD._nearest_parts(n, c)
    assert cost == pytest.approx(d.min(axis=1), abs=1e-12)
    assert d[np.arange(1500), near] == pytest.approx(d.min(axis=1), abs=1e-12)
    tracemalloc.start()
    WD.compressed(n, c, np.zeros(1500), 750)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4e6  # a matrix of all pairs holds 18 MB


def test_nearest_features_equal_brute_force_also_among_ties(rng):
    for c in (np.round(rng.normal(size=(700, 3)), 1), rng.normal(size=(700, 3)) * 1e-4 + 1e3, np.repeat(rng.normal(size=(7, 3)), 100, axis=0)):
        n = rng.integers(1, 900, len(c)).astype(float)
        d = sum((v[:, None] - v) ** 2 for v in c.T) * (n[:, None] * n / (n[:, None] + n))
        np.fill_diagonal(d, np.inf)
        near, cost = WD._nearest_parts(n, c)
        assert near.tolist() == d.argmin(axis=1).tolist() and cost.tolist() == d.min(axis=1).tolist()  # ties: the first
        some = rng.permutation(len(c))[:50]
        assert WD._nearest_parts(n, c, some)[0].tolist() == near[some].tolist()


def test_equal_rows_take_no_rounds_and_others_few(rng, monkeypatch):
    asked = []
    plain = WD._nearest_parts
    monkeypatch.setattr(WD, "_nearest_parts", lambda n, c, rows=None: (asked.append(len(n) if rows is None else len(rows)), plain(n, c, rows))[1])
    c = np.repeat(rng.normal(size=(40, 5)), 50, axis=0)
    n, centers, q = WD.compressed(np.ones(2000), c, np.zeros(2000), 64)
    assert n.tolist() == [50.0] * 40 and centers.tolist() == c[::50].tolist() and not q.any() and asked == []
    n, centers, q = WD.compressed(np.ones(2000), rng.normal(size=(2000, 5)), np.zeros(2000), 1000)
    assert len(n) == 1000 and n.sum() == 2000 and asked[0] == 2000 and all(b < a for a, b in zip(asked, asked[1:])) and sum(asked) < 5000
