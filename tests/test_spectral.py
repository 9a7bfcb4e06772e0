import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import spectral as SP


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")


def asked(points):
    return points.where("id % 20 = 0")


@pytest.mark.parametrize("n", [2000, 12000])
def test_recall_of_neighbours_holds_as_the_table_grows(spark, rng, n):
    x = rng.normal(size=(n, 5)) * [1, 1, 3, 0.1, 1]
    points = frame(spark, x)
    edges = SP.neighbors(points)
    assert SP.recall(points, edges, asked(points)) >= 0.95
    assert edges.groupBy("src").count().agg(F.min("count"), F.max("count")).first()[:] == (10, 10)


def test_neighbours_do_not_depend_on_partitions(spark, rng, monkeypatch):
    monkeypatch.setattr(SP, "CELL", 200)
    points = frame(spark, np.concatenate([rng.normal(size=(900, 3)), np.zeros((700, 3))]))  # equal rows fill cells
    one, two = (sorted(map(tuple, SP.neighbors(points.repartition(p, "id")).collect())) for p in (2, 9))
    assert one == two
    true = SP.exact_neighbors(points, points.where("id < 900"), 10, block=300).groupBy("src").agg(F.max("d2")).collect()
    far = dict((r[0], r[1]) for r in true)
    assert np.mean([d <= far[s] * (1 + 1e-9) for s, _, d in one if s < 900]) > 0.9


def rings(rng, n):
    t = rng.uniform(0, 2 * np.pi, n)
    r = np.where(np.arange(n) % 2, 1.0, 3.0) + rng.normal(size=n) * 0.08
    return np.stack([r * np.cos(t), r * np.sin(t)], axis=1), np.arange(n) % 2


@pytest.mark.parametrize("entries", [24, 1024])
def test_eigenvalues_equal_a_dense_solver(spark, rng, entries):
    x = rng.normal(size=(300, 2)) + np.repeat([[0, 0], [3, 0], [0, 4]], 100, axis=0)
    points = frame(spark, x)
    links = SP.graph(SP.neighbors(points)).cache()
    w = np.zeros((len(x), len(x)))
    for r in links.collect():
        w[r.src, r.dst] = r.w
    assert np.allclose(w, w.T)
    deg = w.sum(axis=1)
    want = np.linalg.eigvalsh(w / np.sqrt(deg[:, None] * deg))[::-1][:4]
    feature = SP.KM.assign(points, SP.WD.features_of(points, entries)[1], keep=["id"], name="feature")
    got, basis, rounds = SP.eigenvectors(links, feature, 4, tol=1e-7)
    assert got == pytest.approx(want, abs=1e-4)
    v = np.array([r[2:] for r in sorted(basis.collect())])
    assert v.T @ v == pytest.approx(np.eye(4), abs=1e-6)


def test_two_rings_are_split(spark, rng):
    x, truth = rings(rng, 800)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(9999, None, 1.0)], "key long, a double, b double")
    found = SP.spectral(df, ["a", "b"], 2, keep=["key"], entries=128)
    own = np.array([r.cluster for r in sorted(found.collect())])
    assert len(own) == 800
    assert max(np.mean(own == truth), np.mean(own != truth)) == 1.0
    assert SP.spectral(df.where("false"), ["a", "b"], 2, keep=["key"]).count() == 0


def test_neighbours_and_ground_truth_equal_brute_force(spark, rng, monkeypatch):
    monkeypatch.setattr(SP, "CELL", 100)
    x = np.concatenate([rng.normal(size=(700, 3)), np.zeros((500, 3)), rng.normal(size=(10, 3)) * 50])
    x[:, 0] = np.round(x[:, 0])
    points = frame(spark, x)
    d = ((x[:, None] - x) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :10]
    for edges, ids in ((SP.neighbors(points), range(len(x))), (SP.exact_neighbors(points, asked(points), block=70), range(0, len(x), 20))):
        rows = edges.toPandas().sort_values(["src", "d2"])
        assert rows["src"].tolist() == np.repeat(ids, 10).tolist()
        assert rows["d2"].to_numpy().reshape(-1, 10) == pytest.approx(want[list(ids)], abs=1e-12)
        assert d[rows["src"], rows["dst"]] == pytest.approx(rows["d2"].to_numpy(), abs=1e-12)
        assert not rows.duplicated(["src", "dst"]).any()


@pytest.mark.parametrize("links_of_a_tile", [1 << 21, 300])
def test_packed_products_over_blocks_and_tiles_equal_dense_ones(spark, rng, monkeypatch, links_of_a_tile):
    monkeypatch.setattr(SP, "BLOCK", 400)
    monkeypatch.setattr(SP, "BLOCKS", 8)
    monkeypatch.setattr(SP, "LINKS", links_of_a_tile)
    ids = rng.permutation(1000)[:400] * 7 - 500  # in no order, with gaps
    points = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, rng.normal(size=(400, 2)))], "id long, x array<double>")
    edges = SP.neighbors(points).cache()
    place = {int(i): j for j, i in enumerate(sorted(ids))}
    w = np.zeros((400, 400))
    for r in edges.collect():
        w[place[r.src], place[r.dst]] += 0.5
        w[place[r.dst], place[r.src]] += 0.5
    deg = w.sum(axis=1)
    own = np.arange(400) // 80
    feature = spark.createDataFrame([(i, int(own[j])) for i, j in place.items()] + [(99999, 4)], "id long, feature long")  # the last has no links
    turn, table = rng.normal(size=(3, 3)), rng.normal(size=(5, 3))
    links = SP.both_ways(edges) if links_of_a_tile == 300 else SP.graph(edges)
    packed = SP._Packed(links, feature)
    rows, coarse = packed.coarse()
    member = np.eye(5)[own]
    assert coarse == pytest.approx(member.T @ w @ member)
    found = packed.unpacked(packed.times(packed.start(rows, table), turn), np.eye(3), ["a", "b", "c"]).orderBy("id").collect()
    assert [r.id for r in found] == sorted(place) and [r.deg for r in found] == pytest.approx(deg)
    x = table[own] * np.sqrt(deg)[:, None] @ turn
    assert np.array([r[2:] for r in found]) == pytest.approx((x + w / np.sqrt(deg[:, None] * deg) @ x) / 2, abs=1e-12)
    assert (packed.tiles.groupBy("block").count().agg(F.max("count")).first()[0] > 1) == (links_of_a_tile == 300)


def test_a_rounds_block_goes_after_the_next_one(spark, rng):
    points = frame(spark, rng.normal(size=(200, 2)))
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    feature = points.select("id", F.floor(F.col("id") / 20).cast("long").alias("feature"))
    _, basis, rounds = SP.eigenvectors(SP.graph(SP.neighbors(points)), feature, 2, tol=0, max_rounds=3)
    assert rounds == 3 and basis.count() == 200
    assert sum(f.startswith("block-") for f in set(os.listdir(shared)) - before) == 1
