"""OLS, diagnostics, selection and evaluation against numpy brute force on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, to_np
from stratum.functions import tails
from stratum.operators import diagnostics as D
from stratum.operators import evaluate as E
from stratum.operators import ols as L
from stratum.operators import selection as S
from stratum.operators import terms as T
from stratum.operators.registry import ModelRegistry
from stratum.plans import panels

Y, XS = "total_value", ["n_orders", "avg_value", "share_finished"]


@pytest.fixture(scope="module")
def panel(spark):
    return panels.customer_year_panel(spark, SF_SMALL)


def _design(panel, cols):
    data = to_np(panel, [Y, *cols])
    return np.column_stack([np.ones(len(data)), data[:, 1:]]), data[:, 0]


def test_ols_matches_lstsq(spark, panel):
    m = L.fit_ols(panel, Y, XS)
    x, y = _design(panel, XS)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    np.testing.assert_allclose(m.coef, beta, rtol=1e-7, atol=1e-9)
    e = y - x @ beta
    s2 = e @ e / (len(y) - x.shape[1])
    se = np.sqrt(np.diag(s2 * np.linalg.inv(x.T @ x)))
    tab = m.coefficients(spark).toPandas()
    np.testing.assert_allclose(tab["std_err"], se, rtol=1e-6)
    assert ((tab["p_value"] >= 0) & (tab["p_value"] <= 1)).all()
    met = m.metrics()
    assert 0 <= met["r2"] <= 1 and met["rmse"] > 0
    assert met["rmse"] == pytest.approx(math.sqrt(e @ e / len(y)), rel=1e-9)


def test_vif_condition_influence(spark, panel):
    m = L.fit_ols(panel, Y, XS)
    x, y = _design(panel, XS)
    xr = x[:, 1:]
    xtx = xr.T @ xr
    vif_ref = np.diag(np.linalg.inv(xtx)) * np.diag(xtx)
    np.testing.assert_allclose(list(m.vif().values()), vif_ref, rtol=1e-7)
    assert m.condition_number() == pytest.approx(np.linalg.cond(x), rel=1e-6)
    h_ref = np.einsum("ij,jk,ik->i", x, np.linalg.inv(x.T @ x), x)
    infl = D.influence(m, panel, keep=["c_custkey", "year"]).toPandas()
    np.testing.assert_allclose(np.sort(infl["leverage"]), np.sort(h_ref), rtol=1e-6)
    assert infl["cooks_d"].min() >= 0


def test_formula_and_design_fit_agree(spark, panel):
    a = L.fit_ols(panel, Y, ["n_orders", "avg_value"])
    b = L.fit_design(panel.withColumn("const", F.lit(1.0)), Y, ["const", "n_orders", "avg_value"])
    np.testing.assert_allclose(a.coef, b.coef, rtol=1e-6)


def test_missing_columns_raise(spark, panel):
    with pytest.raises(KeyError):
        L.fit_ols(panel, "nope", ["n_orders"])
    with pytest.raises(KeyError):
        L.fit_ols(panel, Y, ["nope"])
    m = L.fit_ols(panel, Y, ["n_orders"])
    with pytest.raises(KeyError):
        m.predict(panel.drop("n_orders"))


def test_terms_interactions_powers_dummies_splines(spark, panel):
    m = L.fit_ols(panel, Y, ["n_orders*avg_value", "I(n_orders^2)", "C(c_mktsegment)", "bs(acctbal, df=4)"])
    names = m.names
    assert "n_orders:avg_value" in names and "I(n_orders^2)" in names
    assert sum(n.startswith("C(c_mktsegment)") for n in names) == 4
    assert sum(n.startswith("acctbal_bs") for n in names) == 4


def test_cv_from_fold_grams_matches_refits(spark, panel):
    sel = S.Selector(panel, Y, [], ["n_orders", "avg_value"], cv_folds=4, seed=5, key=["c_custkey", "year"])
    scores = sel.cv.rmse_scores([0, 1])
    from stratum.functions.hashrand import fold_id

    pdf = panel.withColumn("fold", fold_id(5, 4, "c_custkey", "year")).toPandas()
    ref = []
    for f in sorted(pdf.fold.unique()):
        tr, te = pdf[pdf.fold != f], pdf[pdf.fold == f]
        x = np.column_stack([np.ones(len(tr)), tr[["n_orders", "avg_value"]]])
        b, *_ = np.linalg.lstsq(x, tr[Y], rcond=None)
        xt = np.column_stack([np.ones(len(te)), te[["n_orders", "avg_value"]]])
        ref.append(math.sqrt(np.mean((te[Y] - xt @ b) ** 2)))
    np.testing.assert_allclose(scores, ref, rtol=1e-7)


def test_forward_selection_matches_brute_force(spark, panel):
    cands = ["n_orders", "avg_value", "share_finished", "acctbal"]
    path = S.Selector(panel, Y, [], cands).path("forward", "aic", threshold=0.0)
    pdf = panel.toPandas()

    def aic(cols):
        x = np.column_stack([np.ones(len(pdf))] + [pdf[c] for c in cols])
        b, *_ = np.linalg.lstsq(x, pdf[Y], rcond=None)
        rss = float(np.sum((pdf[Y] - x @ b) ** 2))
        n, p = len(pdf), x.shape[1]
        return 2 * p + n * (math.log(2 * math.pi) + math.log(rss / n) + 1)

    cur, best = [], aic([])
    while True:
        opts = [(aic(cur + [c]), c) for c in cands if c not in cur]
        if not opts:
            break
        v, c = min(opts)
        if v < best:
            cur, best = cur + [c], v
        else:
            break
    assert path.best.terms == cur
    assert path.steps[-1].metrics["aic"] == pytest.approx(best, rel=1e-9)
    with pytest.raises(ValueError):
        S.Selector(panel, Y, [], cands).path("sideways")


def test_durbin_watson_and_anderson_darling(spark, rng):
    e = rng.normal(size=500)
    pdf_df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(e)], "t int, resid double")
    dw = D.durbin_watson(pdf_df, "resid", ["t"])
    assert dw == pytest.approx(np.sum(np.diff(e) ** 2) / np.sum(e ** 2), rel=1e-10)
    a2, p = D.anderson_darling(pdf_df, "resid")
    z = np.sort((e - e.mean()) / e.std(ddof=1))
    from math import erfc, log, sqrt

    cdf = np.array([0.5 * erfc(-v / sqrt(2)) for v in z])
    n = len(z)
    i = np.arange(1, n + 1)
    ref = -n - np.sum((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1]))) / n
    assert a2 == pytest.approx(ref, rel=1e-5)
    assert 0 <= p <= 1


def test_registry_and_evaluation(spark, panel):
    reg = ModelRegistry()
    e1 = reg.fit(panel, Y, ["n_orders"])
    assert reg.fit(panel, Y, ["n_orders"]) is e1  # cached
    e2 = reg.fit(panel, Y, ["n_orders", "avg_value"], name="two", cooks_threshold=4.0 / 300)
    assert e2.initial is not None and "two_initial" in reg
    with pytest.raises(ValueError):
        reg.fit(panel, Y, ["n_orders"], name="bad", cooks_threshold=0.0)
    reg.evaluate_all(panel, "self")
    tab = reg.compare(spark, "r2").toPandas()
    assert list(tab["r2"]) == sorted(tab["r2"], reverse=True)
    train, test = E.split(panel, ["c_custkey", "year"], 0.3, 1)
    assert train.count() + test.count() == panel.count()


def test_within_transform_equals_dummy_regression(spark, rng):
    """OLS9: entity fixed effects by demeaning give the dummy-variable coefficients and standard errors."""
    ents = np.repeat(np.arange(8), 15)
    x = rng.normal(size=ents.size) + ents * 0.3
    y = 2.0 * x + ents * 1.5 + rng.normal(size=ents.size)
    df = spark.createDataFrame([(int(e), float(a), float(b)) for e, a, b in zip(ents, x, y)], "e int, x double, y double")
    w = L.within_transform(df, "e", ["x", "y"])
    m = L.fit_ols(w, "y", ["x"], intercept=False, absorbed=8)
    dummies = (ents[:, None] == np.arange(8)[None, :]).astype(float)
    xd = np.column_stack([x, dummies])
    b, *_ = np.linalg.lstsq(xd, y, rcond=None)
    e = y - xd @ b
    s2 = e @ e / (len(y) - xd.shape[1])
    se = math.sqrt(s2 * np.linalg.inv(xd.T @ xd)[0, 0])
    assert m.coef[0] == pytest.approx(b[0], rel=1e-9)
    assert math.sqrt(m.cov_params[0, 0]) == pytest.approx(se, rel=1e-9)


def test_exact_fit_is_handled(spark):
    """A model that reproduces the target exactly (RSS = 0) gives NaN/inf criteria, not an error."""
    rows = [(float(i), float(i % 7), float(i) * float(i % 7)) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    sel = S.Selector(df, "y", ["a", "b"], ["a:b"])
    step = sel.fit(["a", "b", "a:b"])
    assert step.metrics["rss"] == pytest.approx(0.0, abs=1e-6)
    assert math.isnan(step.cp)
    rows_out = sel.interaction_screen(["a", "b"], [("a", "b")], df)
    assert len(rows_out) == 1


def test_registry_paths_and_save(spark, panel):
    from stratum.session import scratch_path

    reg = ModelRegistry()
    sel = S.Selector(panel, Y, [], ["n_orders", "avg_value", "acctbal"])
    paths = sel.grid(directions=("forward", "backward"), criteria=("aic", "bic"))
    entries = reg.register_best_paths(paths)
    assert len(entries) == 4 and len({e.name for e in entries}) == 4
    path = scratch_path(spark, "registry-test")
    reg.save(spark, path)
    assert spark.read.parquet(f"{path}/coefficients").count() == sum(len(e.model.coef) for e in reg)
    assert spark.read.parquet(f"{path}/metrics").count() == len(reg)


def test_registry_add_rules_assumptions_and_frozen_predictions(spark, panel):
    from stratum.session import scratch_path

    reg = ModelRegistry()
    e = reg.fit(panel, Y, ["n_orders"], name="one")
    with pytest.raises(KeyError):
        reg.add(e)
    assert reg.add(e, overwrite=True) is reg.get("one") and len(reg) == 1
    for missing in (reg.get, reg.remove, lambda n: reg.assumptions_table(spark, [n])):
        with pytest.raises(KeyError):
            missing("none")
    reg.fit(panel, Y, ["n_orders", "avg_value"], name="two", cooks_threshold="4/n")
    order = ["c_custkey", "year"]
    tab = {r.model: r for r in reg.assumptions_table(spark, ["two", "one"], order).collect()}
    assert list(tab) == ["two", "one"]
    for name, r in tab.items():
        entry = reg.get(name)
        checks = D.assumption_checks(entry.model, entry.frame, order)
        assert r.white_pvalue == pytest.approx(checks["white_pvalue"]) and r.durbin_watson == pytest.approx(checks["durbin_watson"])
    assert tab["two"].max_cooks_d == pytest.approx(D.influence(reg.get("two").model, reg.get("two").frame).agg({"cooks_d": "max"}).first()[0])
    assert reg.assumptions_table(spark, ["one"]).first().durbin_watson is None
    reg.add(type(e)("loose", ["n_orders"], e.model, {}))
    with pytest.raises(ValueError):
        reg.assumptions_table(spark)
    frozen = reg.freeze("one", panel, order, scratch_path(spark, "frozen"))
    before = sorted(map(tuple, frozen.collect()))
    reg.fit(panel, Y, ["avg_value"], name="one", refit=True)
    assert sorted(map(tuple, frozen.collect())) == before and len(before) == panel.count()


def test_typical_values_and_effect_bands(spark, rng):
    rows = [(float(x), float(z), c, w, None) for x, z, c, w in zip(rng.normal(size=90), rng.normal(size=90), "bca" * 30, ["2", "1", "1"] * 30)]
    rows = [(x, z, c, w, n, 2 * x - z + "abc".index(c) + rng.normal()) for x, z, c, w, n in rows] + [(None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "x double, z double, c string, w string, n double, y double")
    model = L.fit_ols(df, "y", ["x", "z", "x:z", "C(c)"])
    seen = E.typical_values(model, df, but=["x"])
    assert seen["c"] == "a" and seen["z"] == pytest.approx(np.mean([r[1] for r in rows[:-1]]))
    assert E.typical_values(L.OLSModel("y", (T.Term("w", F.col("w"), ("w",)), T.Term("n", F.col("n"), ("n",))), True, None, None, 0, 0, 0, None), df) == {"w": "1", "n": None}
    band = E.effect_band(model, df, "x", n_points=5).toPandas()
    xs = np.array([r[0] for r in rows[:-1]])
    design = lambda x, z, c: np.column_stack([np.ones_like(x), x, z, x * z, c == "b", c == "c"]).astype(float)
    m = design(xs, np.array([r[1] for r in rows[:-1]]), np.array([r[2] for r in rows[:-1]]))
    y = np.array([r[5] for r in rows[:-1]])
    b = np.linalg.lstsq(m, y, rcond=None)[0]
    cov = np.linalg.inv(m.T @ m) * ((y - m @ b) @ (y - m @ b)) / (len(y) - 6)
    grid = np.linspace(xs.min(), xs.max(), 5)
    d = design(grid, np.full(5, seen["z"]), np.full(5, "a"))
    q = tails.t_ppf(0.975, len(y) - 6)
    se = np.sqrt(np.einsum("ij,jk,ik->i", d, cov, d))
    np.testing.assert_allclose(band[["x", "fit", "lower", "upper"]], np.column_stack([grid, d @ b, d @ b - q * se, d @ b + q * se]), rtol=1e-7, atol=1e-9)
    by = E.effect_band(model, df, "c").toPandas().sort_values("c")
    d = design(np.full(3, xs.mean()), np.full(3, seen["z"]), np.array(list("abc")))
    assert list(by.c) == ["a", "b", "c"]
    np.testing.assert_allclose(by.fit, d @ b, rtol=1e-7)
    grid = E.interaction_grid(model, df, "x", "c", n_points=4).toPandas()
    at = design(grid.x.to_numpy(), np.full(len(grid), seen["z"]), grid.c.to_numpy())
    np.testing.assert_allclose(grid.yhat, at @ b, rtol=1e-7)
    with pytest.raises(KeyError):
        E.effect_band(model, df, "w")
    with pytest.raises(ValueError):
        E.effect_band(model, df, "c", max_levels=2)
