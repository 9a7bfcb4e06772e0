"""Principal axes in SQL against numpy; exact products in the screen; the chain's numbering."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from stratum.operators import selection as S
from stratum.plans.sql_eigen import axes_sql, score_sql


@pytest.mark.parametrize("k", [2, 3, 5])
@pytest.mark.parametrize("correlation", [False, True])
def test_axes_equal_numpy(k, correlation):
    rng = np.random.default_rng(k)
    x = rng.normal(size=(400, k)) @ rng.normal(size=(k, k)) + 7.0
    names = [f"c{i}" for i in range(k)]
    t = pd.DataFrame(x, columns=names)
    t.loc[3, "c0"] = None  # an incomplete row takes no part
    full = t.dropna().to_numpy()
    con = duckdb.connect()
    con.register("t", t.astype(object).where(t.notna(), None).astype(float))
    con.execute("CREATE VIEW u AS SELECT " + ", ".join(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" for c in names) + " FROM t")
    mat = np.corrcoef(full.T) if correlation else np.cov(full.T)
    values, vectors = np.linalg.eigh(mat)
    for c in range(1, k + 1):
        v = vectors[:, -c] * np.sign(vectors[np.argmax(np.abs(vectors[:, -c])), -c])
        got = con.execute(f"WITH RECURSIVE {axes_sql('a', 'u', names, c, correlation)} SELECT {', '.join(f'v{i}' for i in range(k))}, l FROM a_v{c}").fetchone()
        np.testing.assert_allclose(got, [*v, values[-c]], rtol=1e-7, atol=1e-9)
    scores = con.execute(f"WITH RECURSIVE {axes_sql('a', 'u', names, 1)} SELECT {score_sql('a', names, 1, 'p')} FROM u p, a_s, a_v1 WHERE p.c0 IS NOT NULL").fetchall()
    w, q = np.linalg.eigh(np.cov(full.T))
    v = q[:, -1] * np.sign(q[np.argmax(np.abs(q[:, -1])), -1])
    np.testing.assert_allclose(sorted(s[0] for s in scores), sorted((full - full.mean(axis=0)) @ v), atol=1e-8)


def test_a_product_that_fits_exactly_has_no_tail(spark):
    rng = np.random.default_rng(4)
    a, b, c = rng.normal(size=(3, 200))
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": c, "y": a * b}))
    exact, other = S.Selector(df, "y", ["a", "b"], []).interaction_screen(["a", "b"], [("a", "b"), ("a", "c")], df)
    assert exact["coef"] == pytest.approx(1.0) and exact["p_value"] is None and exact["delta_aic"] is None
    assert 0.0 <= other["p_value"] <= 1.0 and other["delta_aic"] <= 2.0
