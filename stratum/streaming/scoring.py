"""Applying fitted models to streams.

The reference has no streaming operators.  What carries over is a property:
every fitted model here is a handful of literals (scaler means/sds, outlier
fences, PCA loadings, OLS coefficients), so applying it is a stateless
projection that Structured Streaming runs unchanged on micro-batches.
Fitting still happens on a batch DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.ols import OLSModel
from ..operators.outliers import Fences
from ..operators.pca import PCAModel
from ..operators.scale import ScalerModel
from ..sources.tables import table


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A table, one file or a folder of files, as a file stream (schema taken from the batch reader, never inferred)."""
    schema = table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]"))  # a pattern, since the source takes a plain path for a folder


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process what the stream holds now into a Parquet folder, and read it."""
    query = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def score_stream(stream: DataFrame, keep: Sequence[str] = (), scaler: ScalerModel | None = None,
                 fences: Fences | None = None, pca: PCAModel | None = None, model: OLSModel | None = None) -> DataFrame:
    """One projection applying any of the fitted models (STD4, OUT1/OUT2 masks, PCA2, OLS5)."""
    out = stream
    cols = list(keep)
    if fences is not None:
        masks = fences.masks()
        out = out.withColumns(masks)
        cols += list(masks)
    if model is not None:
        out = out.withColumn("yhat", model.predict_expr())
        cols.append("yhat")
    if scaler is not None:
        out = scaler.transform(out)
        cols += [c for c in scaler.columns if c not in cols]
    if pca is not None:
        scores = pca.score_columns()
        out = out.withColumns(scores)
        cols += list(scores)
    return out.select(*cols)
