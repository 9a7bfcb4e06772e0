"""Registered queries: clustering, cluster quality, isolation forest, smoothers, supervised PCA."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..frames import small_frame
from ..operators import cluster as CL
from ..operators import groups as G
from ..operators import iforest as IF
from ..operators import lloyd as KM
from ..operators import lowess as LW
from ..operators import mixture as MX
from ..operators import ols as L
from ..operators import penalized as EN
from ..operators import outliers as O
from ..operators import scale as SC
from ..operators import silhouette as SI
from ..operators import smooth as SM
from ..operators import spectral as SP
from ..operators import ward as WD
from ..operators.rank import global_index
from ..sources.tables import table
from . import panels
from .catalog import query, rounded

PANEL_SQL = panels.CUSTOMER_YEAR_PANEL_SQL
FEATS = ["n_orders", "avg_value", "max_value", "share_finished", "acctbal"]
_KX, _KY = "avg_value", "max_value"
_K = 3


def _r(x):
    return f"round({x}, 6) + 0.0"


def _lloyd_sql(source: str, start: str, columns: list[str], ks: list[int], starts: int) -> str:
    """CTEs ``p`` (rows), ``it`` (centres by fit and step: fit = 100 k + start) and ``last`` (the converged centres).

    ``start`` is the text, with ``st``, whose md5 orders the rows that a start takes.
    """
    f = [f"f{i}" for i in range(len(columns))]
    d = " + ".join(f"(p.{c} - it.{c}) * (p.{c} - it.{c})" for c in f)
    moved = ", ".join(f"abs(coalesce(m.{c}, it.{c}) - it.{c})" for c in f)
    return f"""WITH RECURSIVE p AS MATERIALIZED (SELECT c_custkey, year, row_number() OVER () AS r, {", ".join(f"{c} AS {n}" for c, n in zip(columns, f))} FROM {source}),
s AS (SELECT p.*, st, row_number() OVER (PARTITION BY st ORDER BY md5({start})) - 1 AS j FROM p, (SELECT unnest(range({starts})) AS st)),
it AS (
  SELECT k * 100 + st AS fit, j, 0 AS step, 1.0::DOUBLE AS moved, 0.0::DOUBLE AS q, {", ".join(f)} FROM s, (SELECT unnest({ks}) AS k) WHERE j < k
  UNION ALL
  (WITH a AS (SELECT it.fit, p.r, arg_min(it.j, {d}) AS j, min({d}) AS q, {", ".join(f"any_value(p.{c}) AS {c}" for c in f)}
              FROM it, p WHERE it.moved > 1e-9 AND it.step < 500 GROUP BY it.fit, p.r),
        m AS (SELECT fit, j, sum(q) AS q, {", ".join(f"avg({c}) AS {c}" for c in f)} FROM a GROUP BY fit, j)
   SELECT it.fit, it.j, it.step + 1, max(greatest({moved})) OVER (PARTITION BY it.fit), coalesce(m.q, 0), {", ".join(f"coalesce(m.{c}, it.{c})" for c in f)}
   FROM it LEFT JOIN m ON m.fit = it.fit AND m.j = it.j WHERE it.moved > 1e-9 AND it.step < 500)),
last AS (SELECT it.* FROM it JOIN (SELECT fit, max(step) AS step FROM it GROUP BY fit) e ON it.fit = e.fit AND it.step = e.step),
best AS (SELECT fit // 100 AS k, arg_min(fit, q) AS fit, min(q) AS inertia FROM (SELECT fit, sum(q) AS q FROM last GROUP BY fit) GROUP BY 1)"""


_KM_SQL = _lloyd_sql(PANEL_SQL, "'km|' || c_custkey || '|' || year", [_KX, _KY], [_K], 1) + f"""
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, {_r("avg(f0)")} AS mean_x, {_r("avg(f1)")} AS mean_y
FROM (SELECT p.r, any_value(p.f0) AS f0, any_value(p.f1) AS f1, arg_min(c.j, (p.f0 - c.f0) * (p.f0 - c.f0) + (p.f1 - c.f1) * (p.f1 - c.f1)) AS cluster
      FROM p, last c GROUP BY p.r) GROUP BY cluster"""


@query("kmeans_fixed_start", oracle=_KM_SQL)
def kmeans_fixed_start(spark, sf):
    """CLU1: Lloyd to convergence from the rows of the smallest md5 keys."""
    p = panels.customer_year_panel(spark, sf).select("c_custkey", "year", _KX, _KY)
    points = panels.materialize(KM.as_points(p, [_KX, _KY], keep=["c_custkey", "year"]))
    h = F.md5(F.concat(F.lit("km|"), F.col("c_custkey").cast("string"), F.lit("|"), F.col("year").cast("string")))
    init = np.array([r["x"] for r in points.orderBy(h).limit(_K).collect()])  # k start rows
    fit = KM.fit_many(points, [init])[0]
    lab = KM.assign(points.withColumn("y", F.col("x")), fit.centers, keep=["y"])
    return rounded(lab.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("y")[0]).alias("mean_x"), F.avg(F.col("y")[1]).alias("mean_y")))


@query("kmeans_embeddings")
def kmeans_embeddings(spark, sf):
    """CLU1: MLlib k-means (k-means||) with restarts on the 64-d embeddings."""
    emb = table(spark, sf, "embeddings")
    res = CL.kmeans(emb, "embedding", k=10, n_init=20, seed=1)
    return res.assign(emb, "embedding").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


_Z_SQL = f"(SELECT c_custkey, year, {', '.join(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}' for c in FEATS)} FROM {PANEL_SQL})"
_Z_BUSY = _Z_SQL.replace("SELECT c_custkey, year,", "SELECT c_custkey, year, CAST(least(n_orders, 4) AS INTEGER) AS busy,", 1)
_START = "'0|' || st || '|' || c_custkey || '|' || year"


@query("elbow_inertia", oracle=_lloyd_sql(_Z_SQL, _START, FEATS, [2, 3, 4, 5, 6], KM.STARTS) + """
SELECT CAST(k AS INTEGER) AS k, round(inertia, 4) AS inertia FROM best""")
def elbow_inertia(spark, sf):
    """CLU2: least inertia of ten starts a k, all fits in the same scans."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    return rounded(KM.elbow(z, FEATS, ["c_custkey", "year"], [2, 3, 4, 5, 6]), 4)


_SIL_D = " + ".join(f"(p.f{i} - c.f{i}) * (p.f{i} - c.f{i})" for i in range(len(FEATS)))
_SIL_SUMS = ", ".join(f"sum(f{i}) AS s{i}" for i in range(len(FEATS)))
_SIL_TO = " + ".join(f"n * l.f{i} * l.f{i} - 2 * l.f{i} * s{i}" for i in range(len(FEATS)))


@query("silhouette_by_k", oracle=_lloyd_sql(_Z_SQL, _START, FEATS, [2, 3, 4], KM.STARTS) + f""",
l AS (SELECT b.k, p.r, arg_min(c.j, {_SIL_D}) AS j, {", ".join(f"any_value(p.f{i}) AS f{i}" for i in range(len(FEATS)))}
      FROM best b JOIN last c ON c.fit = b.fit, p GROUP BY b.k, p.r),
g AS (SELECT k, j, count(*)::DOUBLE AS n, {_SIL_SUMS}, sum({" + ".join(f"f{i} * f{i}" for i in range(len(FEATS)))}) AS q FROM l GROUP BY k, j),
t AS (SELECT l.k, l.r, l.j, g.j AS other, n, {_SIL_TO} + q AS total FROM l JOIN g ON l.k = g.k),
ab AS (SELECT k, r, max(CASE WHEN j = other THEN total / greatest(n - 1, 1) END) AS a, min(CASE WHEN j <> other THEN total / n END) AS b,
              max(CASE WHEN j = other THEN n END) AS own FROM t GROUP BY k, r)
SELECT CAST(k AS INTEGER) AS k, {_r("avg(CASE WHEN own <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END)")} AS silhouette_sq FROM ab GROUP BY k""")
def silhouette_by_k(spark, sf):
    """CLU3: mean silhouette of the best of ten starts a k."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    return rounded(KM.silhouette_by_k(z, FEATS, ["c_custkey", "year"], [2, 3, 4]))


@query("silhouette_rows", oracle=f"""
WITH u AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS d
           FROM embeddings),
nr AS (SELECT vec_id, label, sum(v * v) AS q FROM u GROUP BY vec_id, label),
cs AS (SELECT label, d, sum(v) AS s FROM u GROUP BY label, d),
cn AS (SELECT label, CAST(count(*) AS DOUBLE) AS n, sum(q) AS qq FROM nr GROUP BY label),
dots AS (SELECT u.vec_id, cs.label AS c, sum(u.v * cs.s) AS dot FROM u JOIN cs ON u.d = cs.d GROUP BY u.vec_id, cs.label),
tot AS (SELECT nr.vec_id, nr.label, dots.c, cn.n * nr.q - 2 * dots.dot + cn.qq AS total, cn.n AS nc
        FROM nr JOIN dots ON nr.vec_id = dots.vec_id JOIN cn ON cn.label = dots.c),
ab AS (SELECT vec_id, label, max(CASE WHEN c = label THEN total / greatest(nc - 1, 1) END) AS a,
              min(CASE WHEN c <> label THEN total / nc END) AS b, max(CASE WHEN c = label THEN nc END) AS own
       FROM tot GROUP BY vec_id, label)
SELECT vec_id, label, {_r("CASE WHEN own <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END")} AS silhouette_sq FROM ab
""")
def silhouette_rows(spark, sf):
    """CLU4: per-row squared-Euclidean silhouette of the given labels, O(n k)."""
    emb = table(spark, sf, "embeddings")
    return rounded(CL.silhouette_sq(emb, "embedding", "label", keep=["vec_id"]))


def _euclidean_sql(rows, key, sample, together="true"):
    """CTEs after ``rows(key..., label, x)``: silhouettes ``sil`` with standard errors, from the first rows of each label by md5.

    ``together`` says which labels ``zh.label`` and ``zs.label`` belong to one clustering.
    """
    names, own = ", ".join(key), ", ".join(f"zh.{c}" for c in key)
    return f"""zr AS MATERIALIZED ({rows}),
zh AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '0', {names}))) AS place, CAST(count(*) OVER (PARTITION BY label) AS DOUBLE) AS n FROM zr),
zs AS (SELECT * FROM zh WHERE place <= {sample}),
zt AS (SELECT {own}, zh.label, zs.label AS c, zh.n AS own, max(zs.n) - CAST(zs.label = zh.label AS INTEGER) AS others, avg(list_distance(zh.x, zs.x)) AS d,
              stddev_samp(list_distance(zh.x, zs.x)) AS sd, count(*) AS seen FROM zh JOIN zs ON {together} AND (zs.label <> zh.label OR zs.place <> zh.place)
       GROUP BY {own}, zh.label, zs.label, zh.n),
ze AS (SELECT *, CASE WHEN seen >= others THEN 0 ELSE sd / sqrt(seen) * sqrt(1 - seen / others) END AS err FROM zt),
ab2 AS (SELECT {names}, label, max(own) AS own, max(d) FILTER (WHERE c = label) AS a, max(err) FILTER (WHERE c = label) AS ea,
               min(d) FILTER (WHERE c <> label) AS b, arg_min(err, d) FILTER (WHERE c <> label) AS eb FROM ze GROUP BY {names}, label),
sil AS (SELECT {names}, label, CASE WHEN own <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette,
               CASE WHEN own <= 1 THEN 0 WHEN a < b THEN sqrt(ea * ea + power(a / b * eb, 2)) / b ELSE sqrt(eb * eb + power(b / a * ea, 2)) / a END AS std_err FROM ab2)"""


@query("silhouette_euclidean", oracle=f"""
WITH {_euclidean_sql("SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings", ["vec_id"], SI.SAMPLE)}
SELECT vec_id, label, {_r("silhouette")} AS silhouette, {_r("std_err")} AS std_err FROM sil
""")
def silhouette_euclidean(spark, sf):
    """CLU4: silhouette of every vector with Euclidean distances, exact where a label has at most 256 rows."""
    return rounded(SI.silhouette(table(spark, sf, "embeddings"), "embedding", "label", ["vec_id"]))


@query("silhouette_euclidean_panel", oracle=f"""
WITH {_euclidean_sql(f"SELECT c_custkey, year, busy AS label, [{', '.join(FEATS)}]::DOUBLE[] AS x FROM {_Z_BUSY}", ["c_custkey", "year"], 64)}
SELECT label AS busy, count(*) AS n, {_r("avg(silhouette)")} AS silhouette, {_r("avg(std_err)")} AS std_err FROM sil GROUP BY label
""")
def silhouette_euclidean_panel(spark, sf):
    """CHD9: mean silhouette of the panel's rows by number of orders, estimated, with the standard error of a row."""
    panel = panels.materialize(panels.customer_year_panel(spark, sf)).withColumn("busy", F.least("n_orders", F.lit(4)).cast("int"))
    z, _ = SC.standardize(panel, FEATS)
    rows = SI.silhouette(z, FEATS, "busy", ["c_custkey", "year"], sample=64)
    return rounded(rows.groupBy("busy").agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"), F.avg("std_err").alias("std_err")))


@query("silhouette_euclidean_by_k", oracle=_lloyd_sql(_Z_SQL, _START, FEATS, [2, 3, 4], KM.STARTS) + f""",
l AS (SELECT b.k, p.r, arg_min(c.j, {_SIL_D}) AS j, any_value(p.c_custkey) AS c_custkey, any_value(p.year) AS year, {", ".join(f"any_value(p.f{i}) AS f{i}" for i in range(len(FEATS)))}
      FROM best b JOIN last c ON c.fit = b.fit, p GROUP BY b.k, p.r),
{_euclidean_sql(f"SELECT c_custkey, year, k * 100 + j AS label, [{', '.join(f'f{i}' for i in range(len(FEATS)))}] AS x FROM l", ["c_custkey", "year"], 64, "zh.label // 100 = zs.label // 100")}
SELECT CAST(label // 100 AS INTEGER) AS k, {_r("avg(silhouette)")} AS silhouette, {_r("avg(std_err)")} AS std_err FROM sil GROUP BY label // 100
""")
def silhouette_euclidean_by_k(spark, sf):
    """CLU3: mean silhouette of the best of ten starts a k, with Euclidean distances."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    return rounded(SI.by_k(z, FEATS, ["c_custkey", "year"], [2, 3, 4], sample=64))


@query("gmm_clusters")
def gmm_clusters(spark, sf):
    """CLU6: three Gaussian components, the likeliest of five starts."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    points = panels.materialize(KM.as_points(z, FEATS, keep=["c_custkey", "year"]))
    starts = KM.hashed_starts(z, FEATS, ["c_custkey", "year"], 3, 5)
    mixture = MX.best_mixture(points, [KM.Fit(s) for s in starts], tol=1e-5)
    return MX.assign(points, mixture).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


_GMM_TOL = 1e-5


def _gmm_sql() -> str:
    """EM of two components in one dimension: ``it`` holds the parameters of each step and the likelihood before it."""
    ld = [f"ln(w{c}) - 0.5 * (x - m{c}) * (x - m{c}) / v{c} - 0.5 * ln(2 * pi() * v{c})" for c in (0, 1)]
    new = ", ".join(f"avg(r{c}) AS w{c}, any_value(m{c}) + sum(r{c} * (x - m{c})) / sum(r{c}) AS m{c}, "
                    f"sum(r{c} * (x - m{c}) * (x - m{c})) / sum(r{c}) - pow(sum(r{c} * (x - m{c})) / sum(r{c}), 2) + {MX.REG} AS v{c}" for c in (0, 1))
    return f"""WITH RECURSIVE p AS MATERIALIZED (SELECT c_custkey, year, (avg_value - avg(avg_value) OVER ()) / stddev_pop(avg_value) OVER () AS x FROM {PANEL_SQL}),
s AS (SELECT x, row_number() OVER (ORDER BY md5('0|0|' || c_custkey || '|' || year)) AS j FROM p),
it AS (
  SELECT 0 AS step, false AS done, NULL::DOUBLE AS ll, 0.5::DOUBLE AS w0, (SELECT x FROM s WHERE j = 1) AS m0, (SELECT var_pop(x) + {MX.REG} FROM p) AS v0,
         0.5::DOUBLE AS w1, (SELECT x FROM s WHERE j = 2) AS m1, (SELECT var_pop(x) + {MX.REG} FROM p) AS v1
  UNION ALL
  (WITH d AS (SELECT it.*, p.x, {ld[0]} AS d0, {ld[1]} AS d1 FROM it, p WHERE NOT it.done AND it.step < 1000),
        t AS (SELECT *, greatest(d0, d1) + ln(exp(d0 - greatest(d0, d1)) + exp(d1 - greatest(d0, d1))) AS l FROM d),
        r AS (SELECT *, exp(d0 - l) AS r0, exp(d1 - l) AS r1 FROM t),
        n AS (SELECT any_value(step) + 1 AS step, coalesce(avg(l) - any_value(ll) <= {_GMM_TOL}, false) AS done, avg(l) AS ll, {new} FROM r HAVING count(*) > 0)
   SELECT n.step, n.done, n.ll, {", ".join(f"CASE WHEN n.done THEN it.{v}{c} ELSE n.{v}{c} END" for c in (0, 1) for v in "wmv")} FROM n, it)),
f AS (SELECT * FROM it ORDER BY step DESC LIMIT 1),
a AS (SELECT CASE WHEN {ld[0]} >= {ld[1]} THEN 0 ELSE 1 END AS c FROM p, f)
SELECT CAST(c AS INTEGER) AS component, {_r("CASE WHEN c = 0 THEN w0 ELSE w1 END")} AS weight, {_r("CASE WHEN c = 0 THEN m0 ELSE m1 END")} AS mean,
       {_r("CASE WHEN c = 0 THEN v0 ELSE v1 END")} AS variance, (SELECT count(*) FROM a WHERE a.c = f2.c) AS n
FROM (SELECT *, unnest([0, 1]) AS c FROM f) f2"""


@query("gmm_one_feature", oracle=_gmm_sql())
def gmm_one_feature(spark, sf):
    """CLU6: two components of the standardised average order value, parameters and rows."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), ["avg_value"])
    points = panels.materialize(KM.as_points(z, ["avg_value"], keep=["c_custkey", "year"]))
    start = KM.hashed_starts(z, ["avg_value"], ["c_custkey", "year"], 2, 1)[0]
    mixture = MX.best_mixture(points, [KM.Fit(start)], tol=_GMM_TOL)
    rows = {r["cluster"]: r["n"] for r in MX.assign(points, mixture).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = [(c, float(mixture.weights[c]), float(mixture.means[c, 0]), float(mixture.covs[c, 0, 0]), rows.get(c, 0)) for c in range(2)]
    return rounded(small_frame(spark, out, "component int, weight double, mean double, variance double, n long"))


@query("hierarchical_micro")
def hierarchical_micro(spark, sf):
    """CLU5: four clusters of all rows in Ward's tree over their clustering features."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    points, tree = WD.ward(z, FEATS, keep=["c_custkey", "year"])
    return tree.assign(points, 4).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("ward_merges")
def ward_merges(spark, sf):
    """CLU5: the merge table of the panel's clustering features."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    return rounded(WD.ward(z, FEATS)[1].merge_table(spark))


_NY = ["n_orders", "total_value", "avg_value", "share_finished"]
_WARD_K = 6
_WARD_D = " + ".join(f"(a.f{i} - b.f{i}) * (a.f{i} - b.f{i})" for i in range(len(_NY)))
_WARD_MEANS = ", ".join(f"avg(f{i}) AS f{i}" for i in range(len(_NY)))


@query("ward_nation_years", oracle=f"""
WITH RECURSIVE p AS (SELECT n_nationkey, year, row_number() OVER (ORDER BY n_nationkey, year) AS r,
         {", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS f{i}" for i, c in enumerate(_NY))} FROM {panels.NATION_YEAR_PANEL_SQL}),
it AS (
  SELECT (SELECT count(*) FROM p) AS k, r, r AS c, {", ".join(f"f{i}" for i in range(len(_NY)))} FROM p
  UNION ALL
  (WITH g AS (SELECT c, count(*) AS n, {_WARD_MEANS} FROM it GROUP BY c),
        m AS (SELECT arg_min(a.c, a.n * b.n / (a.n + b.n) * ({_WARD_D})) AS x, arg_min(b.c, a.n * b.n / (a.n + b.n) * ({_WARD_D})) AS y FROM g a JOIN g b ON a.c < b.c)
   SELECT it.k - 1, it.r, CASE WHEN it.c = m.y THEN m.x ELSE it.c END, {", ".join(f"it.f{i}" for i in range(len(_NY)))}
   FROM it, m WHERE it.k > {_WARD_K}))
SELECT p.n_nationkey, p.year, min(p.r) OVER (PARTITION BY it.c) AS first_row FROM it JOIN p ON p.r = it.r WHERE it.k = {_WARD_K}
""")
def ward_nation_years(spark, sf):
    """CLU5: six clusters of all nation-years; a cluster is named by its first row in order of nation and year."""
    p = panels.materialize(panels.nation_year_panel(spark, sf))
    z, _ = SC.standardize(p, _NY)
    points, tree = WD.ward(z, _NY, keep=["n_nationkey", "year"])
    placed = global_index(tree.assign(points, _WARD_K, keep=["n_nationkey", "year"]), ["n_nationkey", "year"], name="r")
    first = placed.groupBy("cluster").agg((F.min("r") + 1).alias("first_row"))
    return placed.join(first, "cluster").select("n_nationkey", "year", "first_row")


# --- CLU8 -------------------------------------------------------------------------------------------------------
_LAB = ["l_returnflag", "l_linestatus", "ship_year"]
_LAB_SQL = "(SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS VARCHAR) AS ship_year FROM lineitem)"


def _rand_sql(a, b):
    return (f"SELECT '{a}' AS labeling_a, '{b}' AS labeling_b, {_r('(n * (n - 1) / 2 + 2 * nij - sa - sb) / (n * (n - 1) / 2)')}"
            f" AS rand_index FROM (SELECT sum(c) AS n, sum(c * (c - 1) / 2) AS nij FROM "
            f"(SELECT count(*)::DOUBLE AS c FROM {_LAB_SQL} GROUP BY {a}, {b})), "
            f"(SELECT sum(c * (c - 1) / 2) AS sa FROM (SELECT count(*)::DOUBLE AS c FROM {_LAB_SQL} GROUP BY {a})), "
            f"(SELECT sum(c * (c - 1) / 2) AS sb FROM (SELECT count(*)::DOUBLE AS c FROM {_LAB_SQL} GROUP BY {b}))")


@query("rand_index_matrix", oracle=" UNION ALL ".join(
    _rand_sql(a, b) for i, a in enumerate(_LAB) for b in _LAB[i + 1:]))
def rand_index_matrix(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus",
                                             F.year("l_shipdate").cast("string").alias("ship_year"))
    return rounded(CL.rand_matrix(li, _LAB))


# --- CLU9 -------------------------------------------------------------------------------------------------------------
_PROF = ["n_orders", "avg_value", "share_finished"]


@query("cluster_profiles", oracle=f"""
WITH z AS (SELECT c_mktsegment, total_value, {", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in _PROF)} FROM {PANEL_SQL}),
m AS (SELECT c_mktsegment, avg(total_value) AS t, {", ".join(f"avg({c}) AS {c}" for c in _PROF)} FROM z GROUP BY 1),
r AS (SELECT c_mktsegment, CAST(rank() OVER (ORDER BY t DESC, c_mktsegment) AS INTEGER) AS cluster_rank FROM m)
SELECT m.c_mktsegment, {_r("m.t")} AS target_mean, f.feature, {_r("f.mean_z")} AS mean_z, r.cluster_rank
FROM m JOIN r ON m.c_mktsegment = r.c_mktsegment
JOIN (SELECT c_mktsegment, unnest(['{"', '".join(_PROF)}']) AS feature, unnest([{", ".join(_PROF)}]) AS mean_z FROM m) f
  ON f.c_mktsegment = m.c_mktsegment
""")
def cluster_profiles(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    z, _ = SC.standardize(p.select("c_mktsegment", "total_value", *_PROF), _PROF)
    return rounded(CL.cluster_profiles(z, "c_mktsegment", _PROF, "total_value"))


# --- OUT3 ----------------------------------------------------------------------------------------------------------------
@query("isolation_forest")
def isolation_forest(spark, sf):
    """OUT3: rows flagged in the top 1% of isolation-forest scores."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    forest = IF.fit(z, FEATS, key=["c_custkey", "year"], n_trees=100, psi=256, seed=0)
    scored = IF.flag(forest.score(z, keep=["c_custkey", "year"]), contamination=0.01)
    return rounded(scored.filter("anomaly").select("c_custkey", "year", "score"))


@query("detector_comparison_forest")
def detector_comparison_forest(spark, sf):
    """OUT5 with all three detectors: fences, z-scores and isolation forest (the forest's sample has no SQL form)."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    forest = IF.fit(z, FEATS, key=["c_custkey", "year"], n_trees=100, psi=256, seed=0)
    flags = IF.flag(forest.score(z), contamination=0.01).select(F.col("anomaly").cast("int").alias("n_flags"))
    return rounded(O.compare_detectors({"iqr": O.iqr_fences(z, FEATS).flag(z), "zscore": O.zscore_fences(z, FEATS).flag(z), "forest": flags}))


# --- GRP8 -----------------------------------------------------------------------------------------------------------------
@query("supervised_pca")
def supervised_pca(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    z, _ = SC.standardize(p, FEATS)
    kept, _, model = G.supervised_pca(z, FEATS, "total_value", screen=0.25, threshold=0.95)
    return rounded(model.coefficients(spark).select("term", "coef", "std_err", "p_value"))


# --- OLS11 / OLS10 / OLS12 -----------------------------------------------------------------------------------------------------
@query("lowess_curve")
def lowess_curve(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    return rounded(SM.binned_lowess(p, "avg_value", "total_value", frac=0.3))


_LOWESS_FRAC = 0.3


@query("lowess_fit", oracle=f"""
WITH s AS (SELECT c_custkey, year, avg_value AS x, total_value AS y, row_number() OVER (ORDER BY avg_value) - 1 AS i FROM {PANEL_SQL}),
k AS (SELECT CAST(greatest(2, floor({_LOWESS_FRAC} * count(*) + 1e-10)) AS BIGINT) AS k FROM s),
z AS (SELECT a.x + b.x AS v FROM s a, k JOIN s b ON b.i = a.i + k.k),
w AS (SELECT v, row_number() OVER (ORDER BY v) AS place FROM z),
l AS (SELECT s.i, coalesce(max(w.place), 0) AS l FROM s LEFT JOIN w ON w.v < 2 * s.x GROUP BY s.i),
h AS (SELECT s.*, l.l, k.k, greatest(s.x - a.x, b.x - s.x) AS h FROM s JOIN l ON s.i = l.i, k, s a, s b WHERE a.i = l.l AND b.i = l.l + k.k - 1),
d AS (SELECT h.c_custkey, h.year, (n.x - h.x) / h.h AS e, n.y, pow(1 - pow(least(abs(n.x - h.x) / h.h, 1), 3), 3) AS w
      FROM h JOIN s n ON n.i >= h.l AND n.i < h.l + h.k),
f AS (SELECT c_custkey, year, sum(w) AS w, sum(w * e) AS we, sum(w * e * e) AS wee, sum(w * y) AS wy, sum(w * e * y) AS wey FROM d GROUP BY 1, 2)
SELECT c_custkey, year, round((wee * wy - we * wey) / (w * wee - we * we), 4) + 0.0 AS fitted FROM f
""")
def lowess_fit(spark, sf):
    """OLS11: the exact local linear fit of every panel row."""
    p = panels.customer_year_panel(spark, sf)
    return rounded(LW.lowess(p, "avg_value", "total_value", _LOWESS_FRAC, keep=("c_custkey", "year")).select("c_custkey", "year", "fitted"), 4)


@query("random_forest")
def random_forest(spark, sf):
    metrics, _ = SM.random_forest(panels.customer_year_panel(spark, sf), "total_value", FEATS[:1] + FEATS[2:] + [
        "avg_value"], key=["c_custkey", "year"], n_trees=300, max_depth=6)
    return rounded(metrics)


@query("residual_calibration")
def residual_calibration(spark, sf):
    p = panels.customer_year_panel(spark, sf)
    m = L.fit_ols(p, "total_value", ["n_orders"])
    r = m.residuals(p, keep=["c_custkey", "year", "c_mktsegment", "c_nationkey"]).withColumn(
        "year_offset", (F.col("year") - 1995).cast("double")).withColumn("nation", F.col("c_nationkey").cast("string"))
    return rounded(EN.calibrated(r, ["c_mktsegment", "nation"], ["year_offset"], ["c_custkey", "year"]))


_EN_PENALTY, _EN_MIX = 0.1, 0.5


@query("elastic_two_predictors", oracle=f"""
WITH RECURSIVE c AS (SELECT corr(avg_value, max_value) AS r, covar_pop(avg_value, total_value) / stddev_pop(avg_value) / stddev_pop(total_value) AS u,
       covar_pop(max_value, total_value) / stddev_pop(max_value) / stddev_pop(total_value) AS v, stddev_pop(avg_value) AS s1, stddev_pop(max_value) AS s2,
       stddev_pop(total_value) AS sy, avg(avg_value) AS m1, avg(max_value) AS m2, avg(total_value) AS my FROM {PANEL_SQL}),
it AS (SELECT 0 AS step, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2
  UNION ALL
  SELECT step + 1, n1, sign(v - r * n1) * greatest(abs(v - r * n1) - {_EN_PENALTY * _EN_MIX}, 0) / {1 + _EN_PENALTY * (1 - _EN_MIX)}
  FROM (SELECT it.*, c.*, sign(u - r * b2) * greatest(abs(u - r * b2) - {_EN_PENALTY * _EN_MIX}, 0) / {1 + _EN_PENALTY * (1 - _EN_MIX)} AS n1 FROM it, c WHERE step < 2000)),
f AS (SELECT b1 * sy / s1 AS b1, b2 * sy / s2 AS b2, m1, m2, my FROM it, c WHERE step = 2000)
SELECT unnest(['(intercept)', 'avg_value', 'max_value']) AS term, unnest([{_r("my - b1 * m1 - b2 * m2")}, {_r("b1")}, {_r("b2")}]) AS coef FROM f
""")
def elastic_two_predictors(spark, sf):
    """OLS12: an elastic net at a fixed penalty (in units of the target's deviation)."""
    p = panels.customer_year_panel(spark, sf)
    sd = p.agg(F.stddev_pop("total_value")).first()[0]
    net = EN.elastic_net(p.withColumn("y", F.col("total_value") / sd), "y", ["avg_value", "max_value"], penalty=_EN_PENALTY, mix=_EN_MIX)
    rows = [("(intercept)", net.intercept * sd), *((c, b * sd) for c, b in net.numeric.items())]
    return rounded(small_frame(spark, rows, "term string, coef double"))


@query("spectral_micro")
def spectral_micro(spark, sf):
    """CLU7: three clusters of all rows from the eigenvectors of their neighbour graph."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    return SP.spectral(z, FEATS, 3, keep=["c_custkey", "year"]).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("neighbour_recall")
def neighbour_recall(spark, sf):
    """CLU7: share of the ten nearest rows that the graph holds, for the customers divisible by 20 against all rows."""
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    rows = panels.materialize(global_index(KM.as_points(z, FEATS, keep=["c_custkey", "year"]), ["c_custkey", "year"], name="id"))
    points = rows.select("id", "x")
    asked = rows.where("c_custkey % 20 = 0").select("id", "x")
    return small_frame(spark, [(asked.count(), SP.recall(points, SP.neighbors(points), asked))], "n_queries long, recall double")


@query("cluster_agreement")
def cluster_agreement(spark, sf):
    """CLU8: Rand indices of k-means, Ward, mixture and spectral clusters of the same rows."""
    key = ["c_custkey", "year"]
    z, _ = SC.standardize(panels.materialize(panels.customer_year_panel(spark, sf)), FEATS)
    points, best = KM.best_by_k(z, FEATS, key, [3])
    mixture = MX.best_mixture(points, [best[3]], tol=1e-5)
    tree = WD.tree_of(*WD.features_of(points))
    labels = KM.assign(points, best[3].centers, keep=key, name="kmeans")
    for part in (tree.assign(points, 3, keep=key, name="ward"), MX.assign(points, mixture, keep=key, name="mixture"), SP.spectral(z, FEATS, 3, keep=key, name="spectral")):
        labels = labels.join(part, key)
    return rounded(CL.rand_matrix(labels, ["kmeans", "ward", "mixture", "spectral"]))
