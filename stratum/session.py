"""Session helpers: one place for the configuration every entry point shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "stratum", shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build a local one tuned for small test data.

    On a cluster the session already exists (spark-submit / notebook) and is
    returned unchanged; the settings below only apply to a fresh local session.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("STRATUM_MASTER", "local[8]")
    cores = master[master.find("[") + 1 : master.find("]")] if "[" in master else "8"
    parts = shuffle_partitions or (int(cores) if cores.isdigit() else 8)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small shuffle outputs followed by CPU-heavy stages (bootstrap replicates,
        # forest scoring) must not collapse into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A folder already set on the context is kept.  Only a local session
    (tests) gets a private folder when nothing is configured; on a cluster
    that is an error, for executors could not see the driver's folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    configured = configured or context.getCheckpointDir()
    if not configured:
        if not (context.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: several passes read the same rows and lineage ends here."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that is no longer read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
