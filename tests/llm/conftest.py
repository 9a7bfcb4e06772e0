"""Fixtures of the text operators."""

from __future__ import annotations

import pytest

from .plain import DOC_SCHEMA


@pytest.fixture
def documents(spark):
    """``make(rows)``: a documents table from (doc_id, text, lang, source) rows, with extra columns that clash."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], DOC_SCHEMA)
        if extra:  # names that operators use inside
            from pyspark.sql import functions as F

            for name in ("key", "id", "u", "k", "size", "label", "copies", "number", "cell", "stratum", "score", "row", "rank", "n",
                         "found", "gone_key", "t", "of", "place", "kept", "n_words", "spans", "roles", "positive", "html"):
                df = df.withColumn(name, F.lit("other"))
        return df

    return make
