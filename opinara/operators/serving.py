"""Reads of the window table: product filters, request tickets, transfer to a client."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.schemas import WINDOW_SERVED

ALL_PRODUCTS = "All"


def filter_prefix(df: DataFrame, product_id: str = "") -> DataFrame:
    """Products equal to or starting with `product_id`; empty means all. Pushed to the scan."""
    return df.filter(F.col("product_id").startswith(product_id)) if product_id else df


def filter_exact(df: DataFrame, product_id: str = ALL_PRODUCTS) -> DataFrame:
    return df if product_id == ALL_PRODUCTS else df.filter(F.col("product_id") == product_id)


def ticket_for_path(path: Sequence[str]) -> str:
    """Ticket for a path: [name] reads everything, [name, product] filters."""
    if len(path) >= 2:
        return json.dumps({"cmd": "filter", "product_id": path[1]})
    return json.dumps({"cmd": "all"})


def query_windows(windows: DataFrame, ticket: str | bytes) -> DataFrame:
    """Answer a JSON ticket. Any command but "filter" reads everything; bad JSON is an error."""
    try:
        request = json.loads(ticket)
    except (json.JSONDecodeError, UnicodeDecodeError) as problem:
        raise ValueError(f"bad ticket: {problem}") from problem
    if not isinstance(request, dict):
        raise ValueError("bad ticket: not an object")
    command, product = request.get("cmd", ""), request.get("product_id", "")
    if not isinstance(command, str) or not isinstance(product, str):
        raise ValueError("bad ticket: cmd and product_id are text")
    return filter_prefix(windows, product if command == "filter" else "")


def serve_projection(windows: DataFrame) -> DataFrame:
    """Exactly the served columns and types."""
    return windows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WINDOW_SERVED.fields])


def arrow_batches(df: DataFrame, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Hand a result to a client in Arrow batches of at most `rows` rows.

    Executors encode the batches; the driver fetches one partition of them at
    a time and never holds the whole result. An empty result yields one empty
    batch that carries the schema.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as writer:
                    writer.write_batch(part)
                yield pa.RecordBatch.from_pydict({"ipc": [sink.getvalue().to_pybytes()]})

    sent = False
    for row in df.mapInArrow(encode, "ipc binary").toLocalIterator(prefetchPartitions=True):
        with pa.ipc.open_stream(bytes(row.ipc)) as reader:
            for batch in reader:
                sent = True
                yield batch
    if not sent:
        yield pa.RecordBatch.from_pylist([], schema=df.limit(0).toArrow().schema)


def payload_bytes(windows: DataFrame) -> DataFrame:
    """Size of the served rows as JSON text against Arrow column buffers (values and offsets)."""
    served = serve_projection(windows)
    as_json = F.octet_length(F.to_json(F.struct("*"), {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}))
    return (served.agg(F.count("*").alias("records"),
                       F.coalesce(F.sum(as_json), F.lit(0)).alias("json_bytes"),
                       F.coalesce(F.sum(F.octet_length("product_id")), F.lit(0)).alias("_ids"))
            .select("records", "json_bytes",
                    # four 8-byte columns, 4-byte text offsets, text bytes
                    (F.col("records") * 36 + 4 + F.col("_ids")).alias("columnar_bytes")))
