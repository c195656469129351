"""Long texts kept in files, each found again by its place.

Rows that still have to be put in order move the place of their text, some 20 bytes, and get the text itself once they are where
they stay. Every text is compressed by itself and read by itself, so rows may come in any order and texts may be of any size
and number; nothing is held in memory but a few megabytes of a task's own texts.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from opinara.sources.messages import filesystem, remove_folder

#: Where a text is; null if it is null.
PLACE = T.StructType([T.StructField("text_file", T.LongType()), T.StructField("text_start", T.LongType()), T.StructField("text_size", T.IntegerType())])
CODEC = "zstd"
#: A task hands on so many bytes of compressed texts at a time, reads ahead by so many and holds so many files open.
BATCH_BYTES, READ_AHEAD, OPEN_FILES = 4 << 20, 64 << 10, 64


def keep(rows: DataFrame, column: str, root: str) -> DataFrame:
    """Write the texts of a column to files below `root`, a file per task; returns the rows with PLACE instead of the column.

    `root` is a new folder that all machines reach. Files of tasks that are repeated have names of their own.
    """
    rest = [f for f in rows.schema.fields if f.name != column]
    schema = T.StructType([*rest, *PLACE.fields])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(root)
        fs.create_dir(folder, recursive=True)
        codec, number, end = pa.Codec(CODEC, compression_level=3), TaskContext.get().taskAttemptId(), 0
        with fs.open_output_stream(f"{folder}/{number}.texts") as out:
            for batch in batches:
                starts: list[int | None] = []
                sizes: list[int | None] = []
                for text in batch.column(column).cast(pa.binary()):
                    raw = text.as_buffer()
                    if raw is None:
                        starts.append(None)
                        sizes.append(None)
                        continue
                    stored = struct.pack("<I", raw.size) + codec.compress(raw, asbytes=True)
                    out.write(stored)
                    starts.append(end)
                    sizes.append(len(stored))
                    end += len(stored)
                files = [None if s is None else number for s in starts]
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], pa.array(files, pa.int64()),
                                                  pa.array(starts, pa.int64()), pa.array(sizes, pa.int32())], names=schema.fieldNames())

    rows.mapInArrow(write, schema).write.parquet(f"{root}/places")
    return rows.sparkSession.read.schema(schema).parquet(f"{root}/places")


def fetch(rows: DataFrame, root: str, column: str) -> DataFrame:
    """Rows with their texts in `column` instead of PLACE, each task in the order it has them."""
    rest = [f for f in rows.schema.fields if f.name not in PLACE.fieldNames()]
    names = [f.name for f in rest]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Texts(root) as texts:
            for batch in batches:
                for part in by_bytes(batch):
                    yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], texts.at(part)], names=[*names, column])

    return rows.mapInArrow(read, T.StructType([*rest, T.StructField(column, T.StringType())]))


def drop(spark: SparkSession, root: str) -> None:
    """Delete the texts and their places."""
    remove_folder(spark, root)


def by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with less than BATCH_BYTES of texts beside the first one of each."""
    sizes = batch.column("text_size").fill_null(0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // BATCH_BYTES)) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
        if first < last:
            yield batch.slice(first, last - first)


class Texts:
    """A task's view of kept texts."""

    def __init__(self, root: str):
        self.fs, self.folder = filesystem(root)
        self.codec = pa.Codec(CODEC)
        self.files: dict[int, io.BufferedReader] = {}
        self.open = ExitStack()

    def __enter__(self) -> Texts:
        return self

    def __exit__(self, *_: object) -> None:
        self.open.close()

    def file(self, number: int) -> io.BufferedReader:
        if number not in self.files:
            if len(self.files) >= OPEN_FILES:
                self.open.close()
                self.files.clear()
            raw: pafs.NativeFile = self.fs.open_input_file(f"{self.folder}/{number}.texts")
            self.files[number] = self.open.enter_context(io.BufferedReader(raw, READ_AHEAD))
        return self.files[number]

    def at(self, rows: pa.RecordBatch) -> pa.Array:
        """The texts of some rows, read in the order of their places."""
        files, starts, sizes = (rows.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in PLACE.fieldNames())
        found: list[bytes | None] = [None] * len(rows)
        for i in np.lexsort((starts, files)).tolist():
            if sizes[i] >= 0:
                file = self.file(int(files[i]))
                file.seek(int(starts[i]))
                stored = file.read(int(sizes[i]))
                found[i] = self.codec.decompress(memoryview(stored)[4:], struct.unpack_from("<I", stored)[0], asbytes=True)
        return pa.array(found, pa.binary()).view(pa.string())
