"""Registered queries: correlation, covariance, standardization, PCA, feature groups."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..functions.transforms import log1p
from ..operators import corr as C
from ..operators import groups as G
from ..operators import pca as P
from ..operators import scale as S
from . import panels
from .catalog import query, rounded
from .sql_eigen import axes_sql, score_sql, tables_sql

LI = panels.LINEITEM_FEATURES
LI_SQL = panels.LINEITEM_SQL
PANEL_SQL = panels.CUSTOMER_YEAR_PANEL_SQL
NULL_PANEL_SQL = panels.PLANTED_NULLS_SQL


def _z_sql(cols, src, keys=(), fit=None):
    """Columns z-scored (population) by the rows where ``fit`` holds; all rows by default."""
    over = f"FILTER (WHERE {fit}) OVER ()" if fit else "OVER ()"
    return "(SELECT " + ", ".join([*keys, *[f"({c} - avg({c}) {over}) / stddev_pop({c}) {over} AS {c}" for c in cols]]) + f" FROM {src})"


def _pairs_sql(cols, src, expr=lambda c: c):
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({expr(a)}, {expr(b)}) AS r FROM {src}"
             for a, b in combinations(cols, 2)]
    return " UNION ALL ".join(parts)


# --- COR1/COR2: all pairs -------------------------------------------------------------------
@query("corr_pairs", oracle=f"""
SELECT feature_a, feature_b, round(r, 6) + 0.0 AS correlation, round(abs(r), 6) + 0.0 AS abs_correlation,
       feature_a || ' vs ' || feature_b AS pair
FROM ({_pairs_sql(LI, LI_SQL)})
""")
def corr_pairs(spark, sf):
    return rounded(C.correlation(panels.lineitem(spark, sf), LI).pairs(spark))


# --- TOP1: strongest pairs ------------------------------------------------------------------
@query("corr_top_pairs", oracle=f"""
SELECT feature_a, feature_b, round(r, 6) + 0.0 AS correlation, round(abs(r), 6) + 0.0 AS abs_correlation,
       feature_a || ' vs ' || feature_b AS pair
FROM ({_pairs_sql(panels.PANEL_FEATURES, PANEL_SQL)})
ORDER BY abs(r) DESC, feature_a, feature_b LIMIT 5
""")
def corr_top_pairs(spark, sf):
    res = C.correlation(panels.customer_year_panel(spark, sf), panels.PANEL_FEATURES)
    return rounded(res.top_pairs(spark, n=5))


# --- COR3: feature-target correlations ------------------------------------------------------
_TGT = "total_value"
_TGT_FEATS = ["n_orders", "avg_value", "max_value", "share_finished", "acctbal"]


@query("corr_target", oracle="SELECT feature, round(r, 6) + 0.0 AS correlation FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, corr({f}, {_TGT}) AS r FROM {NULL_PANEL_SQL}" for f in _TGT_FEATS) + ")")
def corr_target(spark, sf):
    df = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    return rounded(C.target_correlations(df, _TGT_FEATS, _TGT))


# --- COR1 pairwise complete on NULLs -------------------------------------------------------
_NULL_COLS = ["total_value", "avg_value", "max_value", "share_finished"]


@query("corr_matrix_pairwise", oracle=f"""
SELECT a.f AS feature_a, b.f AS feature_b,
       round(CASE WHEN a.f = b.f THEN 1.0 ELSE coalesce(p1.r, p2.r) END, 6) + 0.0 AS correlation
FROM (VALUES {", ".join(f"('{c}')" for c in _NULL_COLS)}) a(f)
CROSS JOIN (VALUES {", ".join(f"('{c}')" for c in _NULL_COLS)}) b(f)
LEFT JOIN ({_pairs_sql(_NULL_COLS, NULL_PANEL_SQL)}) p1 ON p1.feature_a = a.f AND p1.feature_b = b.f
LEFT JOIN ({_pairs_sql(_NULL_COLS, NULL_PANEL_SQL)}) p2 ON p2.feature_a = b.f AND p2.feature_b = a.f
""")
def corr_matrix_pairwise(spark, sf):
    df = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    return rounded(C.correlation(df, _NULL_COLS).tidy(spark))


# --- COR5: covariance --------------------------------------------------------------------------
@query("covariance_matrix", oracle="SELECT feature_a, feature_b, round(c, 6) + 0.0 AS covariance FROM (" +
       " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, covar_samp({a}, {b}) AS c FROM {LI_SQL}"
                          for a in LI for b in LI) + ")")
def covariance_matrix(spark, sf):
    return rounded(C.covariance(panels.lineitem(spark, sf), LI))


# --- COR4/JOI7: raw vs log1p correlation deltas --------------------------------------------
_DELTA_COLS = ["n_orders", "total_value", "avg_value", "max_value"]


@query("corr_delta", oracle=f"""
SELECT a.feature_a, a.feature_b, round(a.r, 6) + 0.0 AS corr_before, round(b.r, 6) + 0.0 AS corr_after,
       round(b.r - a.r, 6) + 0.0 AS delta, round(abs(b.r) - abs(a.r), 6) + 0.0 AS abs_delta
FROM ({_pairs_sql(_DELTA_COLS, PANEL_SQL)}) a
JOIN ({_pairs_sql(_DELTA_COLS, PANEL_SQL, lambda c: f"ln(1 + {c})")}) b
  ON a.feature_a = b.feature_a AND a.feature_b = b.feature_b
""")
def corr_delta(spark, sf):
    panel = panels.customer_year_panel(spark, sf).select(*_DELTA_COLS)
    before = C.correlation(panel, _DELTA_COLS)
    after = C.correlation(S.apply_transforms(panel, {c: log1p for c in _DELTA_COLS}), _DELTA_COLS)
    return rounded(C.correlation_delta(before, after, spark))


# --- STD1: z-scores (population sd) -------------------------------------------------------------
@query("standardize_rows", oracle=f"""
SELECT l_orderkey, l_linenumber, {", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in LI)}
FROM {LI_SQL}
""")
def standardize_rows(spark, sf):
    df = panels.lineitem(spark, sf).select("l_orderkey", "l_linenumber", *LI)
    z, _ = S.standardize(df, LI)
    return rounded(z)


# --- STD2/STD3: transform + median fill + z-score on the NULL panel --------------------------
_TF_COLS = ["n_orders", "avg_value", "max_value", "share_finished"]


@query("tf_and_norm", oracle=f"""
WITH t AS (SELECT c_custkey, year, total_value, ln(1 + n_orders) AS n_orders, ln(1 + avg_value) AS avg_value,
                  ln(1 + max_value) AS max_value, ln(1 + (100 - share_finished)) AS share_finished
           FROM {NULL_PANEL_SQL}),
f AS (SELECT c_custkey, year, total_value,
             coalesce(n_orders, (SELECT quantile_cont(n_orders, 0.5) FROM t)) AS n_orders,
             coalesce(avg_value, (SELECT quantile_cont(avg_value, 0.5) FROM t)) AS avg_value,
             coalesce(max_value, (SELECT quantile_cont(max_value, 0.5) FROM t)) AS max_value,
             coalesce(share_finished, (SELECT quantile_cont(share_finished, 0.5) FROM t)) AS share_finished
      FROM t)
SELECT c_custkey, year, round(total_value, 6) + 0.0 AS total_value, {", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in _TF_COLS)}
FROM f
""")
def tf_and_norm(spark, sf):
    from ..functions.transforms import log1p_under_coverage

    df = panels.with_planted_nulls(panels.customer_year_panel(spark, sf)).select(
        "c_custkey", "year", "total_value", *_TF_COLS)
    tf = {"n_orders": log1p, "avg_value": log1p, "max_value": log1p, "share_finished": log1p_under_coverage}
    out, _ = S.tf_and_norm(df, _TF_COLS, tf)
    return rounded(out)


# --- STD5: before / after summary --------------------------------------------------------------
@query("std_summary", oracle=f"""
SELECT feature, stage, round(mean, 6) + 0.0 AS mean, round(sd, 6) + 0.0 AS sd FROM (
{" UNION ALL ".join(f"SELECT '{c}' AS feature, 'before' AS stage, avg({c}) AS mean, stddev_pop({c}) AS sd FROM {LI_SQL}"
                    for c in LI)}
UNION ALL
{" UNION ALL ".join(f"SELECT '{c}' AS feature, 'after' AS stage, 0.0 AS mean, 1.0 AS sd" for c in LI)})
""")
def std_summary(spark, sf):
    df = panels.lineitem(spark, sf)
    z, _ = S.standardize(df, LI)
    out = S.std_summary(df, z, LI)
    return rounded(out.select("feature", "stage", "mean", "sd"))


# --- PCA1/PCA3/PCA4/PCA2: two columns have closed-form eigen pairs ---------------------------
_PX, _PY = "avg_value", "max_value"
_EIG_SQL = f"""
s AS (SELECT var_samp({_PX}) AS a, covar_samp({_PX}, {_PY}) AS b, var_samp({_PY}) AS d,
             avg({_PX}) AS mx, avg({_PY}) AS my FROM {PANEL_SQL}),
e AS (SELECT *, (a + d) / 2 + sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS l1,
                (a + d) / 2 - sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS l2 FROM s),
v AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS u1, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS u2,
                b / sqrt(b * b + (l2 - a) * (l2 - a)) AS w1, (l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) AS w2 FROM e),
z AS (SELECT *, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END AS su,
                CASE WHEN abs(w1) >= abs(w2) THEN sign(w1) ELSE sign(w2) END AS sw FROM v)
"""


@query("pca_explained_variance", oracle=f"""
WITH {_EIG_SQL}
SELECT 'PC1' AS PC, round(l1, 6) + 0.0 AS variance, round(l1 / (a + d), 6) + 0.0 AS explained_ratio,
       round(l1 / (a + d), 6) + 0.0 AS cumulative_ratio FROM z
UNION ALL
SELECT 'PC2', round(l2, 6) + 0.0, round(l2 / (a + d), 6) + 0.0, round((l1 + l2) / (a + d), 6) + 0.0 FROM z
""")
def pca_explained_variance(spark, sf):
    m = P.fit_pca(panels.customer_year_panel(spark, sf), [_PX, _PY])
    return rounded(m.explained_variance(spark))


@query("pca_loadings", oracle=f"""
WITH {_EIG_SQL}
SELECT '{_PX}' AS feature, 'PC1' AS PC, round(u1 * su, 6) + 0.0 AS loading FROM z
UNION ALL SELECT '{_PY}', 'PC1', round(u2 * su, 6) + 0.0 FROM z
UNION ALL SELECT '{_PX}', 'PC2', round(w1 * sw, 6) + 0.0 FROM z
UNION ALL SELECT '{_PY}', 'PC2', round(w2 * sw, 6) + 0.0 FROM z
""")
def pca_loadings(spark, sf):
    m = P.fit_pca(panels.customer_year_panel(spark, sf), [_PX, _PY])
    return rounded(m.loadings(spark))


@query("pca_scores", oracle=f"""
WITH {_EIG_SQL}
SELECT p.c_custkey, p.year,
       round(((p.{_PX} - z.mx) * z.u1 + (p.{_PY} - z.my) * z.u2) * z.su, 6) + 0.0 AS PC1,
       round(((p.{_PX} - z.mx) * z.w1 + (p.{_PY} - z.my) * z.w2) * z.sw, 6) + 0.0 AS PC2
FROM {PANEL_SQL} p CROSS JOIN z
""")
def pca_scores(spark, sf):
    panel = panels.customer_year_panel(spark, sf)
    m = P.fit_pca(panel, [_PX, _PY])
    return rounded(m.transform(panel, keep=["c_custkey", "year"]))


@query("pca_feature_ranking", oracle=f"""
WITH RECURSIVE {axes_sql("x", _z_sql(LI, LI_SQL), LI, 2)}
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(sqrt(x_v1.v{i} * x_v1.v{i} + x_v2.v{i} * x_v2.v{i}), 6) + 0.0 AS score FROM x_v1, x_v2"
                          for i, c in enumerate(LI)))
def pca_feature_ranking(spark, sf):
    """PCA5 on z-scored lineitem features (k = 4)."""
    df = panels.lineitem(spark, sf)
    z, _ = S.standardize(df, LI)
    m = P.fit_pca(z, LI)
    return rounded(m.feature_ranking(spark, n_pcs=2, method="l2"))


# --- GRP1/GRP4: grouped PCA over the panel -----------------------------------------------------
_GROUPS = (G.FeatureGroup("volume", ("n_orders", "total_value")),
           G.FeatureGroup("price", ("avg_value", "max_value", "share_finished")))


_KEYS = ["c_custkey", "year"]
_Z_ALL = _z_sql(panels.PANEL_FEATURES, PANEL_SQL, _KEYS)


def _variance_sql(g, threshold):
    k = len(g.features)
    at = lambda c: " + ".join(f"{g.name}_v{i}.l" for i in range(1, c + 1))
    total = "(" + " + ".join(f"{g.name}_s.a{i}_{i}" for i in range(k)) + ")"
    return " UNION ALL ".join(
        f"""SELECT '{g.name}' AS "group", 'PC{c}' AS PC, round({g.name}_v{c}.l, 6) + 0.0 AS variance, round({g.name}_v{c}.l / {total}, 6) + 0.0 AS explained_ratio,
        round(({at(c)}) / {total}, 6) + 0.0 AS cumulative_ratio, {f"({at(c - 1)}) / {total} < {threshold} - 1e-12" if c > 1 else "true"} AS retained
        FROM {tables_sql(g.name, k)}""" for c in range(1, k + 1))


@query("grouped_pca_variance", oracle=f"""
WITH RECURSIVE {", ".join(axes_sql(g.name, _Z_ALL, g.features, len(g.features)) for g in _GROUPS)}
{" UNION ALL ".join(_variance_sql(g, 0.8) for g in _GROUPS)}
""")
def grouped_pca_variance(spark, sf):
    panel = panels.customer_year_panel(spark, sf)
    z, _ = S.standardize(panel, panels.PANEL_FEATURES)
    return rounded(G.fit_grouped_pca(z, _GROUPS, threshold=0.8).variance_table(spark))


@query("grouped_pca_summary", oracle=f"""
WITH RECURSIVE {", ".join(axes_sql(g.name, _Z_ALL, g.features, len(g.features)) for g in _GROUPS)},
axes AS ({" UNION ALL ".join(_variance_sql(g, 0.8) for g in _GROUPS)}),
per AS (SELECT "group", CAST(count(*) AS INTEGER) AS n_features, CAST(count(*) FILTER (WHERE retained) AS INTEGER) AS n_axes,
               max(cumulative_ratio) FILTER (WHERE retained) AS explained, max(explained_ratio) AS first_axis FROM axes GROUP BY "group")
SELECT "group", n_features, n_axes, round(n_features / n_axes, 5) + 0.0 AS compression, round(explained, 5) + 0.0 AS explained, round(first_axis, 5) + 0.0 AS first_axis FROM per
UNION ALL SELECT 'all', CAST(sum(n_features) AS INTEGER), CAST(sum(n_axes) AS INTEGER), round(sum(n_features) / sum(n_axes), 5) + 0.0,
                 round(avg(explained), 5) + 0.0, round(avg(first_axis), 5) + 0.0 FROM per
""")
def grouped_pca_summary(spark, sf):
    """GRP2: what the grouped reduction keeps, by group and over all."""
    z, _ = S.standardize(panels.customer_year_panel(spark, sf), panels.PANEL_FEATURES)
    return rounded(G.fit_grouped_pca(z, _GROUPS, threshold=0.8).summary_table(spark), 5)


#: axes that reach the threshold in each group of the z-scored panel
_KEPT = {"volume": 1, "price": 2}


def _group_scores_sql(fit, rows):
    return f"""
WITH RECURSIVE {", ".join(axes_sql(g.name, fit, g.features, _KEPT[g.name]) for g in _GROUPS)}
SELECT p.c_custkey, p.year, {", ".join(f"round({score_sql(g.name, g.features, c, 'p')}, 6) + 0.0 AS {g.name}_PC{c}"
                                       for g in _GROUPS for c in range(1, _KEPT[g.name] + 1))}
FROM {rows} p, {", ".join(tables_sql(g.name, _KEPT[g.name]) for g in _GROUPS)}
"""


@query("grouped_pca_scores", oracle=_group_scores_sql(_Z_ALL, _Z_ALL))
def grouped_pca_scores(spark, sf):
    """GRP2/SET3: retained group scores projected in one select over every panel row."""
    panel = panels.materialize(panels.customer_year_panel(spark, sf))
    z, _ = S.standardize(panel, panels.PANEL_FEATURES)
    model = G.fit_grouped_pca(z, _GROUPS, threshold=0.8)
    return rounded(model.transform(z.select("c_custkey", "year", *[c for g in _GROUPS for c in g.features])))


# --- GRP5: combine two columns with PC1 squared loadings ------------------------------------------
@query("combine_columns", oracle=f"""
WITH {_EIG_SQL}
SELECT p.c_custkey, p.year,
       round(coalesce(p.{_PX}, 0) * z.u1 * z.u1 + coalesce(p.{_PY}, 0) * z.u2 * z.u2, 6) + 0.0 AS price_level
FROM {PANEL_SQL} p CROSS JOIN z
""")
def combine_columns(spark, sf):
    panel = panels.customer_year_panel(spark, sf)
    model = G.fit_combine(panel, [_PX, _PY], "price_level")
    return rounded(model.transform(panel.select("c_custkey", "year", _PX, _PY)))


# --- GRP7: suggested groups by average linkage -------------------------------------------------------
@query("suggest_groups")
def suggest_groups(spark, sf):
    panel = panels.customer_year_panel(spark, sf)
    _, summary = G.suggest_groups(panel, panels.PANEL_FEATURES, threshold=0.5, min_group_size=2)
    return rounded(summary)


# --- FLT9: threshold screen of features by |corr with target| ---------------------------------------
@query("feature_screen", oracle="SELECT feature, round(r, 6) + 0.0 AS correlation FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, corr({f}, {_TGT}) AS r FROM {PANEL_SQL}" for f in _TGT_FEATS) + ") WHERE abs(r) > 0.25")
def feature_screen(spark, sf):
    tc = C.target_correlations(panels.customer_year_panel(spark, sf), _TGT_FEATS, _TGT)
    return rounded(tc.filter(F.abs("correlation") > 0.25))


# --- TOP2/CHD4: strongest positive and negative pairs --------------------------------------------------
@query("signed_top_correlations", oracle=f"""
WITH p AS ({_pairs_sql(panels.PANEL_FEATURES, PANEL_SQL)})
SELECT * FROM (SELECT feature_a, feature_b, round(r, 6) + 0.0 AS correlation, 'positive' AS sign FROM p WHERE r > 0
               ORDER BY r DESC, feature_a, feature_b LIMIT 3)
UNION ALL
SELECT * FROM (SELECT feature_a, feature_b, round(r, 6) + 0.0 AS correlation, 'negative' AS sign FROM p WHERE r < 0
               ORDER BY r ASC, feature_a, feature_b LIMIT 3)
""")
def signed_top_correlations(spark, sf):
    res = C.correlation(panels.customer_year_panel(spark, sf), panels.PANEL_FEATURES)
    pairs = res.pairs(spark).select("feature_a", "feature_b", "correlation")
    return rounded(C.signed_top(pairs, n=3))


# --- STD4: scaler fitted on one year, applied to another -------------------------------------------------
@query("reference_scaling", oracle=f"""
WITH r AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _DELTA_COLS)}
           FROM {PANEL_SQL} WHERE year = 1996)
SELECT c_custkey, year, {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) + 0.0 AS {c}" for c in _DELTA_COLS)}
FROM {PANEL_SQL}, r WHERE year = 1997
""")
def reference_scaling(spark, sf):
    p = panels.customer_year_panel(spark, sf).select("c_custkey", "year", *_DELTA_COLS)
    model = S.fit_scaler(p.filter(F.col("year") == 1996), _DELTA_COLS)
    return rounded(model.transform(p.filter(F.col("year") == 1997)))


# --- PCA6: projecting other rows with a fitted PCA ---------------------------------------------------------
_Z_EARLY = _z_sql(panels.PANEL_FEATURES, PANEL_SQL, _KEYS, "year <= 1997")


@query("pca_project_new", oracle=f"""
WITH RECURSIVE {axes_sql("x", f"(SELECT * FROM {_Z_EARLY} WHERE year <= 1997)", panels.PANEL_FEATURES, 2)}
SELECT p.c_custkey, p.year, {", ".join(f"round({score_sql('x', panels.PANEL_FEATURES, c, 'p')}, 6) + 0.0 AS PC{c}" for c in (1, 2))}
FROM {_Z_EARLY} p, {tables_sql("x", 2)} WHERE p.year > 1997
""")
def pca_project_new(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    z, scaler = S.standardize(p.filter(F.col("year") <= 1997), panels.PANEL_FEATURES)
    m = P.fit_pca(z, panels.PANEL_FEATURES, n_components=2)
    later = scaler.transform(p.filter(F.col("year") > 1997))
    return rounded(m.transform(later, keep=["c_custkey", "year"]))


# --- GRP3/GRP6: grouped PCA transferred to another period; standardized combination ---------------------------
_Z_1996 = _z_sql(panels.PANEL_FEATURES, PANEL_SQL, _KEYS, "year = 1996")


@query("grouped_pca_transfer", oracle=_group_scores_sql(f"(SELECT * FROM {_Z_1996} WHERE year = 1996)", f"(SELECT * FROM {_Z_1996} WHERE year = 1997)"))
def grouped_pca_transfer(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    z, scaler = S.standardize(p.filter(F.col("year") == 1996), panels.PANEL_FEATURES)
    model = G.fit_grouped_pca(z, _GROUPS, threshold=0.8)
    return rounded(model.transform(scaler.transform(p.filter(F.col("year") == 1997)).select(
        "c_custkey", "year", *[c for g in _GROUPS for c in g.features])))


_LEVELS = ["avg_value", "max_value", "share_finished"]
_FILLED = f"(SELECT c_custkey, year, {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in _LEVELS)} FROM {NULL_PANEL_SQL})"


@query("combine_standardized", oracle=f"""
WITH RECURSIVE {axes_sql("x", _FILLED, _LEVELS, 1, correlation=True)}
SELECT p.c_custkey, p.year, round({" + ".join(f"p.{c} * v{i} * v{i}" for i, c in enumerate(_LEVELS))}, 6) + 0.0 AS price_index
FROM {_FILLED} p, x_v1
""")
def combine_standardized(spark, sf):
    p = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    model = G.fit_combine(p, ["avg_value", "max_value", "share_finished"], "price_index", standardize=True)
    return rounded(model.transform(p.select("c_custkey", "year", "avg_value", "max_value", "share_finished")))


# --- CHD3: heatmap matrix with pretty labels ------------------------------------------------------------------
@query("heatmap_labels", oracle=f"""
SELECT a.f AS feature_a, b.f AS feature_b,
       round(CASE WHEN a.f = b.f THEN 1.0 ELSE coalesce(p1.r, p2.r) END, 6) + 0.0 AS correlation,
       a.l AS label_a, b.l AS label_b
FROM (VALUES {", ".join(f"('{c}', '{' '.join(w.capitalize() for w in c.split('_'))}')" for c in LI)}) a(f, l)
CROSS JOIN (VALUES {", ".join(f"('{c}', '{' '.join(w.capitalize() for w in c.split('_'))}')" for c in LI)}) b(f, l)
LEFT JOIN ({_pairs_sql(LI, LI_SQL)}) p1 ON p1.feature_a = a.f AND p1.feature_b = b.f
LEFT JOIN ({_pairs_sql(LI, LI_SQL)}) p2 ON p2.feature_a = b.f AND p2.feature_b = a.f
""")
def heatmap_labels(spark, sf):
    from ..functions.transforms import pretty_name

    res = C.correlation(panels.lineitem(spark, sf), LI)
    labels = spark.createDataFrame([(c, pretty_name(c)) for c in LI], "f string, l string")
    t = res.tidy(spark)
    t = t.join(F.broadcast(labels.toDF("feature_a", "label_a")), "feature_a")  # k label rows
    t = t.join(F.broadcast(labels.toDF("feature_b", "label_b")), "feature_b")
    return rounded(t)


# --- PCA7: biplot data -----------------------------------------------------------------------------------------------
_Z_LI = _z_sql(LI, LI_SQL)


@query("biplot_data", oracle=f"""
WITH RECURSIVE {axes_sql("x", _Z_LI, LI, 2)},
arrow AS (SELECT greatest(max(abs({score_sql("x", LI, 1, "p")})), max(abs({score_sql("x", LI, 2, "p")}))) AS far FROM {_Z_LI} p, {tables_sql("x", 2)}),
load AS ({" UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, x_v1.v{i} AS a, x_v2.v{i} AS b FROM x_v1, x_v2" for i, c in enumerate(LI))})
SELECT feature, CAST(row_number() OVER (ORDER BY a * a + b * b DESC, i) AS INTEGER) AS rank,
       round(far / (SELECT max(greatest(abs(a), abs(b))) FROM load), 6) + 0.0 AS arrow_scale
FROM load, arrow QUALIFY rank <= 3
""")
def biplot_data(spark, sf):
    z, _ = S.standardize(panels.lineitem(spark, sf), LI)
    m = P.fit_pca(z, LI)
    top, scale = m.biplot_scale(z, top=3)
    return rounded(spark.createDataFrame([(f, i + 1, float(scale)) for i, f in enumerate(top)],
                                         "feature string, rank int, arrow_scale double"))


# --- GRP1/GRP4 with two-column groups: closed-form eigenvalues per group -------------------------------
_PAIR_GROUPS = (G.FeatureGroup("volume", ("n_orders", "total_value")), G.FeatureGroup("price", ("avg_value", "max_value")))


def _group_eig_sql(name, x, y, src):
    return f"""SELECT '{name}' AS grp, a, d, (a + d) / 2 + sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS l1,
       (a + d) / 2 - sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS l2
FROM (SELECT var_samp({x}) AS a, covar_samp({x}, {y}) AS b, var_samp({y}) AS d FROM {src})"""


_Z_PANEL = f"""(SELECT {", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}"
                                  for c in ["n_orders", "total_value", "avg_value", "max_value"])} FROM {PANEL_SQL})"""


@query("grouped_pca_pairs", oracle=f"""
WITH e AS ({" UNION ALL ".join(_group_eig_sql(g.name, *g.features, _Z_PANEL) for g in _PAIR_GROUPS)})
SELECT grp AS "group", 'PC1' AS PC, round(l1, 6) + 0.0 AS variance, round(l1 / (a + d), 6) + 0.0 AS explained_ratio,
       round(l1 / (a + d), 6) + 0.0 AS cumulative_ratio, true AS retained FROM e
UNION ALL
SELECT grp, 'PC2', round(l2, 6) + 0.0, round(l2 / (a + d), 6) + 0.0, round((l1 + l2) / (a + d), 6) + 0.0,
       l1 / (a + d) < 0.8 - 1e-12 FROM e
""")
def grouped_pca_pairs(spark, sf):
    """GRP1/GRP4 on z-scored panel features in two-column groups, threshold 0.8."""
    cols = ["n_orders", "total_value", "avg_value", "max_value"]
    z, _ = S.standardize(panels.customer_year_panel(spark, sf).select(*cols), cols)
    return rounded(G.fit_grouped_pca(z, _PAIR_GROUPS, threshold=0.8).variance_table(spark))


# --- COR6: correlation of a model term with the target --------------------------------------------------
@query("term_target_correlation", oracle=f"""
SELECT 'I(n_orders^2)' AS term, round(corr(CAST(n_orders AS DOUBLE) * n_orders, total_value), 6) + 0.0 AS correlation
FROM {PANEL_SQL}
""")
def term_target_correlation(spark, sf):
    from ..operators.terms import expand

    p = panels.customer_year_panel(spark, sf)
    t = expand(["I(n_orders^2)"])[0]
    r = C.term_target_correlation(p.withColumn("_term", t.expr), "_term", "total_value")
    return rounded(spark.createDataFrame([(t.name, r)], "term string, correlation double"))
