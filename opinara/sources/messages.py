"""A topic of messages kept as files, and a stream source that reads it by record offsets.

A topic is a folder with a folder per partition. Its segments are Parquet files named by the offset of their first record, so
a record's offset is the number in the file's name plus its place in the file, and a position in the topic is one number per
partition however many files there are. Segments are never changed; old ones may be deleted, by hand or by a reader that is done
with them.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "messages"
RECORD = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])
ARROW = pa.schema([("key", pa.string()), ("value", pa.string()), ("partition", pa.int32()), ("offset", pa.int64())])
STORED = ["key", "value"]
SEGMENT_ROWS = 100_000
#: Messages are mostly text: a higher level than Spark's 3 takes about 6 % less room for a fifth more CPU in all.
ZSTD = {"parquet.compression.codec.zstd.level": "6"}
#: Rows that get their values after they were placed are sorted by so many a task, or so many bytes of what is attached.
STRETCH_ROWS, STRETCH_BYTES = 50_000, 64 << 20


# --- writing ----------------------------------------------------------------

def in_topic_order(messages: DataFrame, order: Sequence[str | Column], partitions: int,
                   attach: Callable[[DataFrame], DataFrame] | None = None, weight: str | Column | None = None) -> DataFrame:
    """partition, key, value in the order of the topic, each task a stretch of it. attach, weight: as in append_messages."""
    by = ["partition", *order]
    spread = F.xxhash64(F.col("key").cast("string"))
    other = [F.col("value").cast("string")] if attach is None else [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = messages.withColumn("partition", F.pmod(F.when(F.col("key").isNotNull(), spread).otherwise(F.xxhash64(*other)),
                                                    F.lit(partitions)).cast("int"))
    if attach is None:
        placed = dealt.repartitionByRange(*by)
    else:
        n, n_bytes = messages.agg(F.count("*"), F.coalesce(F.sum(F.lit(0) if weight is None else weight), F.lit(0))).first()
        tasks = max(-(-n // STRETCH_ROWS), -(-n_bytes // STRETCH_BYTES), min(-(-n // 5000), messages.sparkSession.sparkContext.defaultParallelism), 1)
        placed = attach(dealt.repartitionByRange(tasks, *by))
    return placed.sortWithinPartitions(*by).select("partition", *[F.col(c).cast("string") for c in STORED])


def append_messages(messages: DataFrame, root: str, order: Sequence[str | Column] = (), partitions: int = 8,
                    segment_rows: int = SEGMENT_ROWS, attach: Callable[[DataFrame], DataFrame] | None = None,
                    weight: str | Column | None = None) -> int:
    """Append (key, value) rows to the topic at `root`; returns how many.

    Values are most of a topic's bytes. With `attach`, `messages` has no value yet: its rows are put in order, then attach adds
    the values to them and keeps their other columns; it must not move rows (a broadcast join, an expression or texts fetched by
    their place do not). `weight` says how many bytes attach adds to a row.

    Messages of one key go to one partition, in the given order; those without key are dealt out by their value (with
    `attach`, by what orders them). A partition
    with a hot key is written by several tasks, each a stretch of it, and offsets follow from the counts of their files. A
    topic has one writer at a time. An append that breaks off has published a beginning of each partition, without gaps;
    appending again repeats those records, as a broker's producer does.
    """
    spark = messages.sparkSession
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    (in_topic_order(messages, order, partitions, attach, weight)
     .write.partitionBy("partition").option("maxRecordsPerFile", segment_rows).option("compression", "zstd").options(**ZSTD).parquet(staging))
    fs, place = _hadoop(spark, root)
    written = (spark.read.schema("key string, value string, partition int").parquet(staging)
               .groupBy("partition", F.col("_metadata.file_path").alias("path")).count().collect())  # a row per file
    ends = _hadoop_ends(spark, root)
    for row in sorted(written, key=lambda r: (r.partition, _written_order(r.path))):
        base = ends.get(row.partition, 0)
        _, folder = _hadoop(spark, f"{root}/partition={row.partition}")
        fs.mkdirs(folder)
        _, target = _hadoop(spark, f"{root}/partition={row.partition}/{base:020d}.parquet")
        if not fs.rename(_hadoop(spark, row.path)[1], target):
            raise OSError(f"cannot publish {target}")
        ends[row.partition] = base + row["count"]
    remove_folder(spark, staging)
    return sum(r["count"] for r in written)


def delete_records(root: str, before: dict[str, int]) -> None:
    """Delete segments that end before these offsets. The last one of a partition stays: it tells the next record's offset."""
    topic = Topic(root)
    for k, paths in topic.segments.items():
        for path, following in zip(paths, paths[1:]):
            if _base(following) <= before.get(k, 0):
                folder, name = path.rsplit("/", 1)
                for gone in (path, f"{folder}/.{name}.crc"):  # Hadoop's local file system keeps a checksum beside a file
                    if topic.fs.get_file_info(gone).type == pafs.FileType.File:
                        topic.fs.delete_file(gone)


def _written_order(path: str) -> tuple[int, int]:
    """Task and number of a file that Spark wrote."""
    task, number = re.search(r"part-(\d+)-.*[.-]c(\d+)\.", path).groups()
    return int(task), int(number)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, place = _hadoop(spark, path)
    fs.delete(place, True)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _hadoop_ends(spark: SparkSession, root: str) -> dict[int, int]:
    """The next offset of every partition, from the name and the count of its last segment."""
    fs, place = _hadoop(spark, root)
    last: dict[int, str] = {}
    for folder in fs.listStatus(place) if fs.exists(place) else []:
        if folder.getPath().getName().startswith("partition="):
            names = sorted(f.getPath().getName() for f in fs.listStatus(folder.getPath()))
            if names:
                last[int(folder.getPath().getName().split("=")[1])] = f"{folder.getPath()}/{names[-1]}"
    return {k: _base(path) + spark.read.parquet(path).count() for k, path in last.items()}


def _base(path: str) -> int:
    return int(path.rsplit("/", 1)[-1].split(".")[0])


# --- reading ----------------------------------------------------------------

@dataclass
class Slice(InputPartition):
    """Records `first` to `last` (exclusive) of a partition, all in one segment."""
    path: str
    partition: int
    first: int
    last: int


class MessageSource(DataSource):
    """Stream source `messages`. Options:

    path: the topic's folder, reachable from every executor through Arrow's file systems.
    startingOffsets: `earliest` (default) or `latest`; a query that goes on from a checkpoint ignores it.
    maxRecords: a batch takes at most so many records (default 500; 0: all there are).
    minRecords, maxDelay: a batch waits until there are so many records or so many seconds went by since the last one
    (defaults 1 and 0: no waiting).
    deleteRead: `true` deletes the segments of batches that are done, as their last reader may (default false).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return RECORD

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return MessageReader({k.lower(): v for k, v in self.options.items()})


class MessageReader(DataSourceStreamReader):
    """Offsets are {partition: next record}. Spark plans a batch by `partitions`, also the last one before a restart, so that
    is where the position moves; asking for the latest offset any number of times changes nothing."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.start = options.get("startingoffsets", "earliest")
        self.most = int(options.get("maxrecords", 500))
        self.least = int(options.get("minrecords", 1))
        self.delay = float(options.get("maxdelay", 0))
        self.deletes = options.get("deleteread", "false").lower() == "true"
        self.at: dict[str, int] = {}
        self.polled: float | None = None
        if self.start not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets: {self.start}")
        if 0 < self.most < self.least:
            raise ValueError("minRecords is more than maxRecords")

    def initialOffset(self) -> dict[str, int]:
        topic = Topic(self.root)
        self.at = topic.begins() if self.start == "earliest" else topic.ends()
        return self.at

    def latestOffset(self) -> dict[str, int]:
        now = time.monotonic()
        self.polled = now if self.polled is None else self.polled
        topic = Topic(self.root)
        # A partition that came after the start is read from its first record on.
        at = {k: self.at.get(k, begin) for k, begin in topic.begins().items()}
        waiting = {k: max(end - at[k], 0) for k, end in topic.ends().items()}
        total = sum(waiting.values())
        if not total or (total < self.least and now - self.polled < self.delay):
            return self.at
        taken = shares(waiting, self.most) if self.most else waiting
        return self.at | {k: at[k] + n for k, n in taken.items() if n or k in self.at}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> Sequence[InputPartition]:
        self.at, self.polled = dict(end), time.monotonic()
        topic = Topic(self.root)
        begins = topic.begins()  # of partitions that came after the start
        since = {k: start.get(k, begins.get(k, 0)) for k in end}
        return [s for k, last in end.items() if last > since[k] for s in topic.slices(k, since[k], last)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(part.path)
        with pq.ParquetFile(path, filesystem=fs) as file:
            row = _base(part.path)  # the offset of the row group's first record
            for group in range(file.num_row_groups):
                n = file.metadata.row_group(group).num_rows
                if row < part.last and row + n > part.first:
                    place = row
                    for batch in file.iter_batches(row_groups=[group], columns=STORED, batch_size=4096):
                        low, high = max(part.first - place, 0), min(part.last - place, len(batch))
                        if low < high:
                            yield record_batch(batch.slice(low, high - low), part.partition, place + low)
                        place += len(batch)
                row += n

    def commit(self, end: dict[str, int]) -> None:
        """The checkpoint keeps the position. Spark calls this for a batch that is done, once it has found records for the next one."""
        if self.deletes:
            delete_records(self.root, end)


def record_batch(stored: pa.RecordBatch, partition: int, first: int) -> pa.RecordBatch:
    n = len(stored)
    columns: list[Any] = [stored.column(c).cast(pa.string()) for c in STORED]
    return pa.RecordBatch.from_arrays([*columns, pa.array([partition] * n, pa.int32()), pa.array(range(first, first + n), pa.int64())],
                                      schema=ARROW)


def shares(waiting: dict[str, int], most: int) -> dict[str, int]:
    """Deal `most` records out to partitions by what waits in each, the remainder one by one to those with more waiting."""
    total = sum(waiting.values())
    if total <= most:
        return dict(waiting)
    taken = {k: n * most // total for k, n in waiting.items()}
    rest = most - sum(taken.values())
    for k in sorted(waiting, key=lambda k: taken[k] - waiting[k])[:rest]:
        taken[k] += 1
    return taken


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


class Topic:
    """The segments of a topic as they are now: per partition the paths, by base offset."""

    def __init__(self, root: str):
        self.fs, folder = filesystem(root)
        self.prefix = root[:len(root) - len(folder)] if root.endswith(folder) else ""
        found = self.fs.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        self.segments: dict[str, list[str]] = {}
        for path in sorted(f.path for f in found if f.type == pafs.FileType.File):
            name = re.search(r"/partition=(\d+)/\d{20}\.parquet$", path)
            if name and "/_staging-" not in path:
                self.segments.setdefault(name[1], []).append(path)

    def begins(self) -> dict[str, int]:
        return {k: _base(paths[0]) for k, paths in self.segments.items()}

    def ends(self) -> dict[str, int]:
        """Only the footer of the last segment is read."""
        return {k: _base(paths[-1]) + pq.read_metadata(paths[-1], filesystem=self.fs).num_rows for k, paths in self.segments.items()}

    def slices(self, partition: str, first: int, last: int) -> list[Slice]:
        """Records first to last, a slice per segment. Records that were deleted before they were read end the query."""
        paths = self.segments.get(partition, [])
        if not paths or _base(paths[0]) > first:
            raise ValueError(f"records of partition {partition} from {first} on are gone")
        stops = [_base(p) for p in paths[1:]] + [last]
        return [Slice(self.prefix + p, int(partition), max(first, _base(p)), min(last, stop))
                for p, stop in zip(paths, stops) if _base(p) < last and stop > first]
