"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Window state can outgrow the heap on a busy stream; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "opinara", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; keyword settings use `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Local mode may fall back to a fresh temporary folder; a cluster may not,
    because other machines could not read it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="opinara-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and read it back.

    Used where two branches of a plan must see identical rows (for instance
    the same partition numbers) even if an executor is lost in between.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
