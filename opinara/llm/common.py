"""What several operators share: documents as Arrow batches, stored tables, arrays of fixed size."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.token_ids import forget
from opinara.session import shared_dir

BLOCK = 1 << 16
#: Texts are made Python objects so many at a time, so that a worker's memory does not follow from the rows of a batch.
SLICE_ROWS = 200


def slices(parts: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, encodes: bool = False) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches that share the memory of the large ones. What was learnt for encoding is kept only if `encodes`."""
    if not encodes:
        forget()
    for batch in parts:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (as UTF-8 bytes, null text as empty); other columns of the input are left behind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *more)


def stored(df: DataFrame) -> DataFrame:
    """Write to a new Parquet table in the shared folder and read it back.

    Cuts the lineage as a checkpoint does, and later readers touch only the columns they need.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches(rows: Iterator[dict], schema: pa.Schema, every: int = 5000) -> Iterator[pa.RecordBatch]:
    """Group rows (dicts) into record batches."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= every:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def fixed_array(df: DataFrame, fill: Callable[[pa.RecordBatch, np.ndarray], None], size: int,
                combine: str = "add") -> np.ndarray:
    """One array of `size` uint32 filled by all rows: `fill` adds a batch to the array of its task.

    Tasks send their arrays as compressed blocks, which are summed (or or-ed) in two rounds, so no task
    holds more than one array. The result has a fixed size, whatever the input has; it is what the driver gets.
    """
    join = np.add if combine == "add" else np.bitwise_or
    schema = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])
    ddl = "block int, part int, data binary"

    def partial(parts):
        total = np.zeros(size, np.uint32)
        seen = False
        for batch in parts:
            fill(batch, total)
            seen = True
        if seen:
            yield from send(total, TaskContext.get().partitionId() % 64)

    def send(total, part):
        blocks = [(i, total[i * BLOCK:(i + 1) * BLOCK]) for i in range(-(-size // BLOCK))]
        yield from batches(({"block": i, "part": int(part), "data": zlib.compress(x.tobytes(), 1)}
                            for i, x in blocks if x.any()), schema)

    def merge(parts):
        held: dict[int, np.ndarray] = {}
        for batch in parts:
            for i, data in zip(batch["block"].to_pylist(), batch["data"].to_pylist()):
                x = np.frombuffer(zlib.decompress(data), np.uint32)
                held[i] = join(held[i], x) if i in held else x
        yield from batches(({"block": i, "part": 0, "data": zlib.compress(x.tobytes(), 1)}
                            for i, x in held.items()), schema)

    out = np.zeros(size, np.uint32)
    sums = df.mapInArrow(partial, ddl).repartition("block", "part").mapInArrow(merge, ddl)
    for row in sums.repartition("block").mapInArrow(merge, ddl).collect():
        at = slice(row.block * BLOCK, (row.block + 1) * BLOCK)
        out[at] = join(out[at], np.frombuffer(zlib.decompress(row.data), np.uint32))
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly (a fixed bijection)."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def likely_members(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id may be in `ids` (one long column): a first pass that spares shuffling the rest."""
    return split_by(docs, ids)[0]


def split_by(docs: DataFrame, ids: DataFrame, bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """Rows of `docs` whose doc_id may be in `ids` (one long column), and those where it is not.

    The filter is a bit array of fixed size. It may let others through, never takes a member for another; join the first
    part afterwards. A null doc_id is never a member. Only ids go through Python.
    """
    name = ids.columns[0]

    def fill(batch, total):
        at = mixed(np.asarray(batch[name].drop_null(), dtype=np.int64)) % np.uint64(bits)
        np.bitwise_or.at(total, (at >> np.uint64(5)).astype(np.int64),
                         np.uint32(1) << (at & np.uint64(31)).astype(np.uint32))

    flags = docs.sparkSession.sparkContext.broadcast(fixed_array(ids, fill, bits // 32, "or"))

    @F.arrow_udf("boolean")
    def member(ids: pa.Array) -> pa.Array:
        at = mixed(ids.fill_null(0).to_numpy(zero_copy_only=False)) % np.uint64(bits)
        hit = flags.value[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)
        return pa.array((hit & np.uint32(1)).astype(bool) & ids.is_valid().to_numpy(zero_copy_only=False))

    known = member(F.col("doc_id").cast("long"))
    return docs.where(known), docs.where(~known)


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name
