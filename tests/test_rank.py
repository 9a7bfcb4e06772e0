import numpy as np
import pytest

from stratum.operators import rank as RK


def plain(values, descending):
    out = []
    for v in values:
        if v is None or v != v:
            out.append(None)
            continue
        known = [w for w in values if w is not None and w == w]
        before = sum(w > v if descending else w < v for w in known)
        out.append(before + (known.count(v) + 1) / 2)
    return out


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_average_rank_of_all_equals_plain(spark, rng, descending, partitions):
    values = [7.0] * 200 + [float(v) for v in rng.integers(0, 30, 300)] + [float("nan"), None, -0.0, 0.0, float("inf")] + rng.normal(size=60).tolist()
    order = rng.permutation(len(values))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.createDataFrame([(int(i), values[i]) for i in order], "id long, v double")
        got = {r.id: r.rank for r in RK.average_rank_of_all(df, "v", descending, partitions=partitions).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [got[i] for i in range(len(values))] == plain(values, descending)


def test_one_value_and_no_rows(spark):
    df = spark.createDataFrame([(i, 3) for i in range(500)], "id long, v int")
    assert {r.rank for r in RK.average_rank_of_all(df, "v", partitions=7).collect()} == {250.5}
    assert RK.average_rank_of_all(df.where("false"), "v").columns == ["id", "v", "rank"]
    assert RK.average_rank_of_all(df.where("false"), "v").count() == 0


def test_global_index_goes_by_row_hash(spark):
    rows = [(i % 3, i) for i in range(60)]
    a, b = (RK.global_index(spark.createDataFrame(rows[::s], "k int, v long").repartition(p), ["k"]).collect() for s, p in ((1, 3), (-1, 8)))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert sorted(np.array([r.idx for r in a]).tolist()) == list(range(60))
