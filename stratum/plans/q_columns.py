"""Registered queries: column selection, views, chains, formula terms and the transform catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import transforms as X
from ..operators import clean as K
from ..operators import scale as S
from ..operators.rank import global_index
from ..operators.terms import expand
from ..roles import Roles, make_view
from . import panels
from .catalog import query, rounded

PANEL_SQL = panels.CUSTOMER_YEAR_PANEL_SQL
NULL_PANEL_SQL = panels.PLANTED_NULLS_SQL
LI_SQL = panels.LINEITEM_SQL
KEYS = ["c_custkey", "year"]
ROLES = Roles(entity="c_custkey", time="year", target="total_value", status="c_mktsegment", identifiers=("c_nationkey",))
FEATURES = ["n_orders", "avg_value", "max_value", "share_finished", "acctbal"]


def _r(x):
    return f"round({x}, 6) + 0.0"


# --- PRJ8-PRJ10, FLT2: a view standardizes the whole frame, selects what is there, drops incomplete rows ---------
@query("standardized_view", oracle=f"""
WITH z AS (SELECT c_custkey, year, total_value, {", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in FEATURES)} FROM {NULL_PANEL_SQL})
SELECT c_custkey, year, {_r("avg_value")} AS avg_value, {_r("max_value")} AS max_value, {_r("total_value")} AS total_value
FROM z WHERE avg_value IS NOT NULL AND max_value IS NOT NULL
""")
def standardized_view(spark, sf):
    """A requested column that the frame lacks is left out; the target is added."""
    p = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    view = make_view(p, ROLES, [*KEYS, "avg_value", "max_value", "not_there"], standardized=True)
    return rounded(view.df)


# --- PRJ10: which columns are features -------------------------------------------------------------------------
_RESOLVED = ["avg_value", "max_value", "share_finished", "acctbal", "c_nationkey"]


@query("feature_means", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, {_r(f'avg({c})')} AS mean FROM {NULL_PANEL_SQL}" for c in _RESOLVED))
def feature_means(spark, sf):
    """Numeric columns without identifiers, target and excludes, and one identifier put back."""
    p = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    cols = K.numeric_feature_columns(p, [*KEYS, "c_nationkey"], "total_value", extra_exclude=["n_orders"], extra_include=["c_nationkey"])
    long = p.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "v")
    return rounded(long.groupBy("feature").agg(F.count("v").alias("n"), F.avg("v").alias("mean")))


# --- FLT1 ------------------------------------------------------------------------------------------------------
@query("target_rows", oracle=f"SELECT c_custkey, year, {_r('avg_value')} AS avg_value, {_r('max_value')} AS max_value FROM {NULL_PANEL_SQL} WHERE avg_value IS NOT NULL")
def target_rows(spark, sf):
    """Rows without the target go; other missing values stay."""
    p = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    return rounded(K.drop_missing_target(p, "avg_value").select(*KEYS, "avg_value", "max_value"))


# --- PRJ11, PRJ13, FLT6, TOP4, UDF3: a chain of frame functions ----------------------------------------------------
@query("chained_steps", oracle=f"""
SELECT l_orderkey, l_linenumber, {_r("mark")} AS mark, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_linenumber / 100.0 + l_quantity) - 1 AS position
FROM (SELECT *, l_linenumber / 100.0 + l_quantity AS mark FROM {LI_SQL} WHERE l_discount <> 0 AND l_quantity <= 15 AND price_k <= 30)
""")
def chained_steps(spark, sf):
    """Error and range filter, two columns combined into one, positions in the order of the keys (equal keys by the mark)."""

    def plausible(df):
        return df.filter((F.col("l_discount") != 0) & (F.col("l_quantity") <= 15) & (F.col("price_k") <= 30))

    def combined(df, minor, major, name):
        return df.withColumn(name, F.col(minor) / 100.0 + F.col(major))

    def numbered(df, keys):
        return global_index(df, keys, "position")

    out = (panels.lineitem(spark, sf).transform(plausible).transform(combined, "l_linenumber", "l_quantity", "mark")
           .select("l_orderkey", "l_linenumber", "mark").transform(numbered, ["l_orderkey", "l_linenumber", "mark"]))
    return rounded(out)


# --- FN7: powers, products, categories ------------------------------------------------------------------------------
_SEGMENTS = f"(SELECT DISTINCT c_mktsegment AS seg FROM {PANEL_SQL} WHERE c_mktsegment IS NOT NULL)"


@query("formula_terms", oracle=f"""
WITH v AS (
SELECT 'I(n_orders^2)' AS term, CAST(n_orders AS DOUBLE) * n_orders AS v FROM {PANEL_SQL}
UNION ALL SELECT 'avg_value', avg_value FROM {PANEL_SQL} UNION ALL SELECT 'acctbal', acctbal FROM {PANEL_SQL}
UNION ALL SELECT 'avg_value:acctbal', avg_value * acctbal FROM {PANEL_SQL}
UNION ALL SELECT 'n_orders:share_finished', n_orders * share_finished FROM {PANEL_SQL}
UNION ALL SELECT 'C(c_mktsegment)[T.' || seg || ']', CASE WHEN c_mktsegment = seg THEN 1.0 ELSE 0.0 END
          FROM {PANEL_SQL}, {_SEGMENTS} WHERE seg > (SELECT min(seg) FROM {_SEGMENTS}))
SELECT term, count(v) AS n, {_r("avg(v)")} AS mean, {_r("stddev_pop(v)")} AS sd FROM v GROUP BY term
""")
def formula_terms(spark, sf):
    """Every term of a formula as a column, summarised; the first category is the base."""
    p = panels.customer_year_panel(spark, sf)
    terms = expand(["I(n_orders^2)", "avg_value*acctbal", "n_orders:share_finished", "C(c_mktsegment)"], p)
    wide = p.select(*[t.expr.cast("double").alias(f"t{i}") for i, t in enumerate(terms)])
    names = F.create_map(*[x for i, t in enumerate(terms) for x in (F.lit(f"t{i}"), F.lit(t.name))])
    long = wide.unpivot([], wide.columns, "t", "v")
    return rounded(long.groupBy(names[F.col("t")].alias("term")).agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")))


# --- FN5: spline columns -----------------------------------------------------------------------------------------------
@query("spline_columns", oracle=f"""
WITH b AS (SELECT min(avg_value) AS lo, max(avg_value) AS hi, quantile_cont(avg_value, 0.5) AS mid FROM {PANEL_SQL}),
t AS (SELECT c_custkey, year, avg_value AS x, lo, hi, mid, (avg_value - lo) / (hi - lo) AS u FROM {PANEL_SQL}, b)
SELECT c_custkey, year, {_r("3 * u * (1 - u) * (1 - u)")} AS cubic1, {_r("3 * u * u * (1 - u)")} AS cubic2, {_r("u * u * u")} AS cubic3,
       {_r("CASE WHEN x < mid THEN (x - lo) / (mid - lo) ELSE (hi - x) / (hi - mid) END")} AS hat1,
       {_r("CASE WHEN x < mid THEN 0.0 ELSE (x - mid) / (hi - mid) END")} AS hat2
FROM t
""")
def spline_columns(spark, sf):
    """A cubic without inner knots is Bernstein's basis; degree one with a knot at the median is a pair of hats."""
    p = panels.materialize(panels.customer_year_panel(spark, sf).select(*KEYS, "avg_value"))
    cubic = expand(["bs(avg_value, df=3, degree=3)"], p)
    hats = expand(["bs(avg_value, df=2, degree=1)"], p)
    return rounded(p.select(*KEYS, *[t.expr.alias(f"cubic{i + 1}") for i, t in enumerate(cubic)], *[t.expr.alias(f"hat{i + 1}") for i, t in enumerate(hats)]))


# --- FN11: transforms named in column metadata ----------------------------------------------------------------------------
_CATALOGUE = {"n_orders": "log1p", "share_finished": "log1p_under_coverage", "acctbal": "none"}


@query("transform_catalogue", oracle=f"""
SELECT c_custkey, year, {_r("ln(1 + n_orders)")} AS n_orders, {_r("ln(1 + (100 - share_finished))")} AS share_finished, {_r("acctbal")} AS acctbal
FROM {NULL_PANEL_SQL}
""")
def transform_catalogue(spark, sf):
    p = panels.with_planted_nulls(panels.customer_year_panel(spark, sf)).select(*KEYS, *_CATALOGUE)
    return rounded(S.apply_transforms(p, {c: X.TRANSFORMS[label] for c, label in _CATALOGUE.items()}))


# --- UDF4: a fitted model is a frozen record with its result as a table -----------------------------------------------------
@query("scaler_parameters", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_r(f'avg({c})')} AS mean, {_r(f'stddev_samp({c})')} AS sd FROM {NULL_PANEL_SQL}" for c in FEATURES))
def scaler_parameters(spark, sf):
    p = panels.with_planted_nulls(panels.customer_year_panel(spark, sf))
    return rounded(S.fit_scaler(p, FEATURES, ddof=1).to_frame(spark))
