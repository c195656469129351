"""Batch writers and the append-only window table."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.tables import WINDOW_KEY, keep_last


def ordered_by_product(reviews: DataFrame, partitions: int | None = None) -> DataFrame:
    """Reviews sorted by product and time across all partitions, in partition order.

    Partitioned by range of (product, date): a product that holds a large part
    of the data is cut into consecutive stretches of time instead of filling
    one task.
    """
    by = ["product_id", "date"]
    placed = reviews.repartitionByRange(partitions, *by) if partitions else reviews.repartitionByRange(*by)
    return placed.sortWithinPartitions(*by)


def publish_counters() -> list[Column]:
    value = F.col("value")
    return [F.count_if(value.isNotNull()).alias("published"), F.count_if(value.isNull()).alias("failed")]


def write_messages(messages: DataFrame, transport: str, options: dict[str, str]) -> Observation:
    """Write (key, value) rows. The observation gives `published` and `failed` once written.

    A message without a value could not be encoded; it is counted, not written.
    """
    seen = Observation()
    counted = messages.observe(seen, *publish_counters())
    counted.filter(F.col("value").isNotNull()).write.format(transport).options(**options).mode("append").save()
    return seen


def append_metrics_csv(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").option("header", True).csv(path)


# --- versioned tables -------------------------------------------------------
# A batch goes to day=<day>/run=<run>/batch_id=<n> folders and readers take the last version per key, by run and then
# batch. A run is what one checkpoint belongs to; its name begins with the time it started, so names sort by start.
# Writing replaces only folders of the same run and batch: nothing that another batch or run wrote is ever overwritten,
# and repeating a batch is harmless. Days come first, so readers of recent days list only their folders.

VERSION = ("run", "batch_id")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that owns a checkpoint; kept beside it, so a restart goes on with the same name."""
    path = f"{checkpoint}/run_name"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(path)
    return name


def append_batch(rows: DataFrame, root: str, batch_id: int, ts: str, run: str = "0", cluster: Sequence[str] = ()) -> None:
    """Write one batch. Files per day follow from the size of the day's rows: large days are split, small ones joined.

    cluster: columns that the rows of a file are sorted by. A filter on the first of them reads only the row groups and
    pages that may hold its value: prefixes by the least and greatest values, single values by a Bloom filter too.
    """
    placed = rows.withColumns({"day": F.to_date(ts), "run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
    placed = placed.hint("rebalance", F.col("day"))
    if cluster:
        placed = placed.sortWithinPartitions("day", *VERSION, *cluster)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if cluster:
        writer = writer.options(**{f"parquet.bloom.filter.enabled#{cluster[0]}": "true", "parquet.bloom.filter.adaptive.enabled": "true"})
    writer.partitionBy("day", *VERSION).parquet(root)


def days_of(rows: DataFrame, ts: str) -> list[date]:
    """The days that some rows touch; a stray old row adds its day, not all the days since."""
    return [r[0] for r in rows.select(F.to_date(ts)).distinct().collect() if r[0] is not None]


def read_versions(spark: SparkSession, root: str, schema: T.StructType, first_day: date | None = None,
                  last_day: date | None = None, days: Iterable[date] | None = None) -> DataFrame:
    """All versions between two days, of some days, or of all days, with day, run and batch_id. No rows if nothing is there yet."""
    stored = T.StructType([*schema.fields, T.StructField("day", T.DateType()), T.StructField("run", T.StringType()),
                           T.StructField("batch_id", T.LongType())])
    path = root
    if first_day is not None and last_day is not None and first_day <= last_day:
        days = [first_day + timedelta(days=n) for n in range((last_day - first_day).days + 1)]
    if days is not None:
        path = f"{root}/day={{{','.join(sorted(map(str, days)))}}}"
    try:
        versions = spark.read.schema(stored).option("basePath", root).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stored)
    if first_day is not None:
        versions = versions.filter(F.col("day") >= F.lit(first_day))
    return versions if last_day is None else versions.filter(F.col("day") <= F.lit(last_day))


def before(versions: DataFrame, run: str, batch_id: int) -> DataFrame:
    """Versions written before a batch of a run; what a repeated batch wrote itself is left out."""
    return versions.filter((F.col("run") < F.lit(run)) | ((F.col("run") == F.lit(run)) & (F.col("batch_id") < batch_id)))


def latest_windows(spark: SparkSession, root: str, schema: T.StructType, first_day: date | None = None,
                   last_day: date | None = None) -> DataFrame:
    """Last version of every window."""
    versions = read_versions(spark, root, schema, first_day, last_day)
    return keep_last(versions, WINDOW_KEY, VERSION).select(*schema.fieldNames())


def compact_windows(spark: SparkSession, root: str, schema: T.StructType, target: str,
                    first_day: date | None = None) -> None:
    """Copy the last versions to a new root, as one batch numbered like the newest one.

    Days before `first_day` are left behind, which is how old windows are retired.
    """
    newest = read_versions(spark, root, schema).agg(F.max(F.struct(*VERSION))).first()[0]
    if newest is not None:
        append_batch(latest_windows(spark, root, schema, first_day), target, newest.batch_id, "window_start", newest.run, WINDOW_KEY)
