"""Registry of named queries and their DuckDB oracle SQL.

Queries are grouped by area in sibling modules that register themselves with
:func:`query`.  Each callable takes ``(spark, sf_dir)`` and returns a
DataFrame; every float output is rounded so that engines agreeing to ~1e-9
hash identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name`` with an optional SQL oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column and normalise -0.0 (oracle hashing)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def load_all() -> None:
    """Import every area module so its queries register."""
    from . import q_clean, q_cluster, q_columns, q_multivariate, q_profile, q_regression, q_sources  # noqa: F401
