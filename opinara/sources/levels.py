"""A log that a stream adds to batch by batch and reads back, kept in levels so that it stays in few files.

Each batch adds a segment per day that it touches. Once `fanout` segments of a day have the same level they are merged into one
of the next level, so a day that n batches touched has about fanout * log(n) segments, whatever n is. Days that a batch
does not touch are neither read nor written.

A manifest per batch names the live segments of every day. A batch starts from the manifest before its own: until its own
is written, what it wrote or merged does not exist, and repeating it writes the same folders again. Segments that a
batch replaced are deleted by the next one, when no repetition can ask for them any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FANOUT = 4
#: Spark's name for the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Segment(NamedTuple):
    """Rows that batches `first` to `last` added to a day; `live` is false for what the manifest's own batch replaced."""
    day: date | None
    first: int
    last: int
    level: int
    live: bool = True

    @property
    def name(self) -> str:
        return f"{self.first}-{self.last}"


#: The last line of a manifest.
END = "end"


class LevelledLog:
    """A log under `root`. merge: from the rows of several segments of some days to fewer rows that mean the same; it gets and
    keeps the columns of `schema` and `_to`, `day` (the segment and day that a row goes to)."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType,
                 merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, fanout: int = FANOUT):
        self.spark, self.root, self.schema, self.merge, self.fanout = spark, root, schema, merge, fanout

    # --- manifests --------------------------------------------------------------

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _manifests(self) -> list[int]:
        fs, place = self._fs(f"{self.root}/manifest")
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(place)) if fs.exists(place) else []

    def segments(self, before: int | None = None) -> list[Segment]:
        """The segments of the newest manifest, or the newest of a batch before `before`."""
        known = [b for b in self._manifests() if before is None or b < before]
        if not known:
            return []
        fs, place = self._fs(f"{self.root}/manifest/batch={known[-1]}")
        stream = fs.open(place)
        try:
            *lines, end = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()
        assert end == END, f"manifest {known[-1]} is cut"
        return [Segment(date.fromisoformat(d) if d else None, int(first), int(last), int(level), live == "live")
                for d, first, last, level, live in (line.split(",") for line in lines)]

    def _publish(self, batch_id: int, segments: list[Segment]) -> None:
        """Written beside and then renamed, so a manifest is there as a whole or not at all."""
        lines = [f"{s.day or ''},{s.first},{s.last},{s.level},{'live' if s.live else 'replaced'}" for s in segments]
        fs, place = self._fs(f"{self.root}/manifest/batch={batch_id}")
        _, draft = self._fs(f"{self.root}/_manifest-{batch_id}")
        out = fs.create(draft, True)
        out.write(bytearray("\n".join([*lines, END]).encode()))
        out.close()
        fs.mkdirs(place.getParent())
        fs.delete(place, False)
        if not fs.rename(draft, place):
            raise OSError(f"cannot publish {place}")

    def _forget(self, batch_id: int, replaced: Iterable[Segment]) -> None:
        """Delete what no manifest before `batch_id` needs any more, and manifests but the last two."""
        old = [f"{self.root}/manifest/batch={b}" for b in self._manifests() if b < batch_id - 1]
        for path in [*(self._folder(s) for s in replaced), *old]:
            fs, place = self._fs(path)
            fs.delete(place, True)

    def _days(self, name: str) -> list[date | None]:
        """The days that a segment's folder holds."""
        fs, place = self._fs(f"{self.root}/_to={name}")
        found = [f.getPath().getName().removeprefix("day=") for f in fs.listStatus(place)] if fs.exists(place) else []
        return [None if d == NO_DAY else date.fromisoformat(d) for d in found]

    def _folder(self, s: Segment) -> str:
        return f"{self.root}/_to={s.name}/day={s.day or NO_DAY}"

    # --- rows -------------------------------------------------------------------

    def _rows(self, segments: list[Segment]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("_to", T.StringType()), T.StructField("day", T.DateType())])
        if not segments:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).option("basePath", self.root).parquet(*map(self._folder, segments))

    def _write(self, rows: DataFrame) -> None:
        (rows.select(*self.schema.fieldNames(), "_to", "day").hint("rebalance", F.col("_to"), F.col("day"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_to", "day").parquet(self.root))

    def read(self, days: Iterable[date] | None = None, before: int | None = None) -> DataFrame:
        """The rows of some days, or of all; before: as they were when that batch began."""
        wanted = None if days is None else set(days)
        return self._rows([s for s in self.segments(before) if s.live and (wanted is None or s.day in wanted)]).select(*self.schema.fieldNames())

    def add(self, rows: DataFrame, batch_id: int, ts: str) -> list[date | None]:
        """Add the rows of a batch, each to the day of its `ts`; returns the days. Adding a batch again replaces it."""
        known = self.segments(batch_id)
        name = f"{batch_id}-{batch_id}"
        fs, place = self._fs(f"{self.root}/_to={name}")
        fs.delete(place, True)  # of an attempt that broke off
        self._write(rows.withColumn("day", F.to_date(ts)).withColumn("_to", F.lit(name)))
        days = self._days(name)
        live, replaced = [s for s in known if s.live and s.day not in days], []
        merges: list[tuple[list[Segment], Segment]] = []
        for day in days:
            own = sorted((s for s in known if s.live and s.day == day), key=lambda s: s.first) + [Segment(day, batch_id, batch_id, 0)]
            while len(own) >= self.fanout and len({s.level for s in own[-self.fanout:]}) == 1:
                first = own[-self.fanout]
                own[-self.fanout:] = [Segment(day, first.first, batch_id, first.level + 1)]
            if own[-1].level:  # one merge, however many levels it goes up
                parts = [s for s in known if s.live and s.day == day and s.first >= own[-1].first] + [Segment(day, batch_id, batch_id, 0)]
                merges.append((parts, own[-1]))
                replaced += [s._replace(live=False) for s in parts]
            live += own
        if merges:
            self._merge(merges)
        self._publish(batch_id, live + replaced)
        self._forget(batch_id, [s for s in known if not s.live])
        return days

    def _merge(self, merges: list[tuple[list[Segment], Segment]]) -> None:
        """All merges of a batch in one job."""
        goes = self.spark.createDataFrame([(s.name, s.day, target.name) for parts, target in merges for s in parts],
                                          "_from string, _day date, _target string")
        rows = self._rows([s for parts, _ in merges for s in parts])
        moved = rows.join(F.broadcast(goes), (F.col("_to") == F.col("_from")) & F.col("day").eqNullSafe(F.col("_day")))
        self._write(self.merge(moved.withColumn("_to", F.col("_target")).select(*self.schema.fieldNames(), "_to", "day")))
