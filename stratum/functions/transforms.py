"""Scalar column functions (FN1-FN11, PRJ12-PRJ16).

Every transform is a ``Column -> Column`` (or ``Column -> dict[name, Column]``
when it expands, e.g. dummies and spline bases), so it stays inside Catalyst
and whole-stage codegen.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Transform = Callable[[Column], "Column | dict[str, Column]"]


def log1p(c: Column) -> Column:
    """FN1."""
    return F.log1p(c)


def log1p_under_coverage(c: Column) -> Column:
    """FN2: ``log1p(100 - x)`` for coverage percentages."""
    return F.log1p(F.lit(100.0) - c)


def identity(c: Column) -> Column:
    return c


def status_dummies(c: Column, name: str, levels: Sequence[str] = ("developing", "developed"),
                   drop_first: bool = True) -> dict[str, Column]:
    """FN3: ordered categories -> 0/1 columns, first level dropped."""
    norm = F.lower(F.trim(c.cast("string")))
    keep = levels[1:] if drop_first else levels
    return {f"{name}_{lvl}": F.when(c.isNull(), None).otherwise((norm == F.lit(lvl)).cast("int")) for lvl in keep}


def one_hot(c: Column, name: str, levels: Sequence, drop_first: bool = True) -> dict[str, Column]:
    """FN4: one-hot over explicit (sorted) levels; levels come from a distinct pass."""
    keep = list(levels)[1:] if drop_first else list(levels)
    return {f"{name}_{slug(str(v))}": (c == F.lit(v)).cast("int") for v in keep}


def domain_index(c: Column, lo: float = 100.0, hi: float = 75000.0) -> Column:
    """PRJ14: ``(ln g - ln lo)/(ln hi - ln lo)`` for g > 0, else NULL."""
    return F.when(c > 0, (F.log(c) - F.lit(math.log(lo))) / F.lit(math.log(hi) - math.log(lo)))


def sentinel_to_null(c: Column, sentinel: float = 0.0) -> Column:
    """PRJ15: treat a sentinel value as missing."""
    return F.when(c != F.lit(sentinel), c)


def positive_only(c: Column) -> Column:
    """FLT5: keep positive values, else NULL."""
    return F.when(c > 0, c)


def nan_to_null(c: Column) -> Column:
    """R1: NaN never enters an aggregate."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def power(c: Column, p: float) -> Column:
    """FN7 ``I(x^p)``."""
    return F.pow(c, F.lit(float(p)))


def product(*cols: Column) -> Column:
    """FN7 interaction ``a:b``."""
    out = cols[0]
    for c in cols[1:]:
        out = out * c
    return out


def slug(text: str) -> str:
    """FN8 slugify: lower case, runs of non ``[a-z0-9]`` -> ``_``."""
    return re.sub(r"[^a-z0-9]+", "_", text.strip().lower()).strip("_")


def slug_col(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def pretty_name(name: str) -> str:
    """PRJ8 fallback label: title case of the ``_``-split name."""
    return " ".join(w.capitalize() for w in name.split("_") if w)


def parse_year(c: Column) -> Column:
    """PRJ4/FN9: text year -> timestamp of Jan 1 (bad -> NULL)."""
    return F.try_to_timestamp(F.trim(c.cast("string")), F.lit("yyyy"))


def mid_year_date(year: Column) -> Column:
    """FN9: build the mid-July date of a year."""
    return F.make_date(year.cast("int"), F.lit(7), F.lit(15))


def age_years(later: Column, earlier: Column) -> Column:
    """AGG20: whole years as ``floor(datediff / 365)``."""
    return F.floor(F.datediff(later, earlier) / F.lit(365)).cast("int")


def invert_smaller_better(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ12: ``max(x) - x`` via one scalar aggregate broadcast as literals."""
    mx = df.agg(*[F.max(c).alias(c) for c in cols]).first()
    return df.withColumns({c: F.lit(mx[c]) - F.col(c) for c in cols})


def time_trend(df: DataFrame, time_col: str, name: str = "trend") -> DataFrame:
    """PRJ16: ``year - min(year)`` from one scalar aggregate."""
    lo = df.agg(F.min(time_col)).first()[0]
    return df.withColumn(name, F.col(time_col) - F.lit(lo))


# Transform catalogue (FN11): names used in column metadata -> functions.
TRANSFORMS: dict[str, Transform] = {
    "none": identity,
    "log1p": log1p,
    "log1p_under_coverage": log1p_under_coverage,
}
