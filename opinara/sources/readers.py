"""Batch and streaming readers. The message transport is a parameter: kafka, a topic kept as files (messages), or plain files."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from opinara.schemas import REVIEW, SLIDING_AGG, WINDOW_AGG
from opinara.sources.codec import decode_json
from opinara.sources.messages import FORMAT, MessageSource

# Topic names and poll size of the message contract.
RAW_TOPIC = "reviews.raw"
WINDOW_TOPIC = "reviews.windowed"
SLIDING_TOPIC = "reviews.aggregated"
MAX_POLL_RECORDS = 500

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def kafka_options(servers: str, topic: str, start: str, per_batch: int | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """A micro-batch takes all there is unless `per_batch` bounds it (the contract's poll size is MAX_POLL_RECORDS)."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start,
               "failOnDataLoss": str(fail_on_data_loss).lower()}
    return options | ({"maxOffsetsPerTrigger": str(per_batch)} if per_batch else {})


def topic_options(path: str, start: str = "earliest", per_batch: int = MAX_POLL_RECORDS, at_least: int = 1,
                  wait_s: float = 0, delete_read: bool = False) -> dict[str, str]:
    """Options of the `messages` transport: polls of at most `per_batch` records (0: all), held back until there are
    `at_least` or `wait_s` seconds have gone by. `delete_read`: what was read is deleted from the topic."""
    return {"path": path, "startingOffsets": start, "maxRecords": str(per_batch), "minRecords": str(at_least), "maxDelay": str(wait_s),
            "deleteRead": str(delete_read).lower()}


def message_stream(spark: SparkSession, transport: str, options: dict[str, str]) -> DataFrame:
    """Stream of (key, value). Kafka and topics kept as files have schemas of their own; file streams (json, parquet) get ours."""
    if transport == FORMAT:
        spark.dataSource.register(MessageSource)
    reader = spark.readStream.format(transport).options(**options)
    return reader.load() if transport in ("kafka", FORMAT) else reader.schema(MESSAGE).load()


def raw_review_stream(spark: SparkSession, transport: str, options: dict[str, str],
                      schema: T.StructType = REVIEW) -> DataFrame:
    """Raw reviews, from the earliest message on; bad JSON arrives in _corrupt_record."""
    return decode_json(message_stream(spark, transport, options), schema)


def window_stream(spark: SparkSession, transport: str, options: dict[str, str]) -> DataFrame:
    return decode_json(message_stream(spark, transport, options), WINDOW_AGG)


def sliding_stream(spark: SparkSession, transport: str, options: dict[str, str]) -> DataFrame:
    return decode_json(message_stream(spark, transport, options), SLIDING_AGG)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def table_from_records(spark: SparkSession, records: pa.Table | Iterable[Any],
                       schema: T.StructType) -> DataFrame:
    """DataFrame with the given schema from an Arrow table, dicts, rows or tuples."""
    if isinstance(records, pa.Table):
        return spark.createDataFrame(records.select(schema.fieldNames()), schema)
    rows = [[r.get(f) for f in schema.fieldNames()] if isinstance(r, dict) else r for r in records]
    return spark.createDataFrame(rows, schema)
