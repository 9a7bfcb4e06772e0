"""Small result frames built from driver-side numbers (k-sized, never row-sized)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _clean(v):
    if isinstance(v, float) and not math.isfinite(v):
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, str)):
        v = v.item()
        if isinstance(v, float) and not math.isfinite(v):
            return None
    return v


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """DataFrame from a short list of tuples; NaN/inf become NULL (rule R1)."""
    return spark.createDataFrame([tuple(_clean(v) for v in r) for r in rows], schema=schema)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric (non-boolean) columns in schema order."""
    from pyspark.sql.types import NumericType

    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]
