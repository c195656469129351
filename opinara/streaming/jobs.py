"""Structured Streaming forms of the window, statistics, dedup and alert operators."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime, timedelta
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from opinara.operators.alerts import COOLDOWN_S, RECENT_S, anomalies
from opinara.operators.scaling import few_or_shuffled
from opinara.operators.stats import review_stats
from opinara.operators.tables import WINDOW_KEY, first_within, keep_last, mark_updates
from opinara.operators.windows import (
    check_sliding,
    classify_arrival,
    finish_tumbling,
    slide_panes,
    sliding_panes,
    total,
    unplaced,
)
from opinara.schemas import REVIEW, WINDOW_AGG
from opinara.session import durable
from opinara.sources.codec import CORRUPT
from opinara.sources.levels import LevelledLog
from opinara.sources.messages import FORMAT, ZSTD, delete_records
from opinara.sources.readers import raw_review_stream, topic_options, window_stream
from opinara.sources.writers import append_batch, before, days_of, latest_windows, publish_counters, read_versions, run_of

# Fixed values of the flush policy.
FLUSH_ROWS = 100
FLUSH_S = 30
DEDUP_HORIZON_S = 120
#: Files of decoded messages: texts that repeat in one are kept once if they are up to 32 MB in all.
DECODED = {"parquet.dictionary.page.size": str(32 << 20), **ZSTD}

ALERT = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("mean_rating", T.DoubleType()),
    T.StructField("negative", T.LongType()), T.StructField("windows", T.LongType()),
    T.StructField("rule", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("sent_at", T.TimestampType()),
])


def flush_every(writer: DataStreamWriter, seconds: int = FLUSH_S, final: bool = False) -> DataStreamWriter:
    """Flush on a timer; `final` drains what is there and stops. By rows or time: `run_flushed`."""
    return writer.trigger(availableNow=True) if final else writer.trigger(processingTime=f"{seconds} seconds")


def run_decoded(spark: SparkSession, topic: str, out: str, checkpoint: str, schema: T.StructType = REVIEW, start: str = "earliest",
                per_batch: int = 500, delete_read: bool = False) -> StreamingQuery:
    """Decode a topic of messages into a table at `out`; rows whose `_corrupt_record` is not null are the messages set apart.

    `delete_read`: a topic that nobody else reads loses its segments once the table has them, so no message is stored twice for long.
    """
    decoded = raw_review_stream(spark, FORMAT, topic_options(topic, start, per_batch, delete_read=delete_read), schema)
    writer = (decoded.writeStream.option("checkpointLocation", checkpoint).format("parquet").option("path", out)
              .option("compression", "zstd").trigger(processingTime="0 seconds"))
    before = {k: spark.conf.get(k, None) for k in DECODED}  # the file sink takes these from the session that starts it, not from its options
    try:
        for k, v in DECODED.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_flushed(spark: SparkSession, topic: str, checkpoint: str, *writes: Callable[[DataFrame, int], None], rows: int = FLUSH_ROWS,
                seconds: float = FLUSH_S) -> StreamingQuery:
    """Hand the windows of a topic to the writers whenever `rows` of them are there, and what there is after `seconds`.

    No batch has more than `rows` messages; of one window it keeps the last. Unreadable ones are left out. A query with `seconds` 0 on the same checkpoint,
    drained, is the last flush of a stream that stops.
    """
    windows = window_stream(spark, FORMAT, topic_options(topic, per_batch=rows, at_least=rows, wait_s=seconds))
    readable = windows.filter(F.col(CORRUPT).isNull()).select(*WINDOW_AGG.fieldNames(), "offset")
    write_all = fan_out(*writes)

    def flush(batch: DataFrame, batch_id: int) -> None:
        write_all(keep_last(batch, WINDOW_KEY, ["offset"]).drop("offset"), batch_id)  # a window has one partition

    return (readable.writeStream.option("checkpointLocation", checkpoint).foreachBatch(flush)
            .trigger(processingTime="0 seconds").start())


def drain(query: StreamingQuery, read_topic: str | None = None) -> None:
    """Take all polls that are there, then stop. `read_topic`: the topic to delete the last poll's segments from, of which Spark would
    tell the source only at the next start."""
    try:
        query.processAllAvailable()
        done = query.lastProgress
    finally:
        query.stop()
    if read_topic and done and (end := json.loads(done.json)["sources"][0]["endOffset"]):
        delete_records(read_topic, end)


def admissible(reviews: DataFrame, width_s: int, lateness_s: int) -> tuple[DataFrame, DataFrame]:
    """(reviews the windows accept, reviews without date or arrival, with the reason)

    Too old ones are in neither; reviews dated after their arrival are accepted like others.
    """
    dated = reviews.filter("date is not null and arrival_ts is not null")
    return classify_arrival(dated, width_s, lateness_s).filter("arrival_class <> 'dropped'").drop("arrival_class"), unplaced(reviews)


PARTIAL = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("window_start", T.TimestampType()),
    T.StructField("r", T.LongType()), T.StructField("l", T.LongType()), T.StructField("c", T.LongType())])


def _set_apart(rows: DataFrame, root: str, batch_id: int, run: str) -> None:
    if not rows.isEmpty():  # mostly there are none, and writing nothing is a job too
        append_batch(rows, root, batch_id, "seen", run)


def partial_log(spark: SparkSession, root: str, run: str) -> LevelledLog:
    """The partial sums of a run; segments are merged by adding up."""
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("product_id", "window_start", "_to", "day").agg(*[F.sum(c).alias(c) for c in "rlc"])
    return LevelledLog(spark, f"{root}/_partials/run={run}", PARTIAL, merge)


def tumbling_partials(reviews: DataFrame, width_s: int, lateness_s: int) -> DataFrame:
    """What some reviews add to each window. The order in which reviews are read does not matter."""
    kept, _ = admissible(reviews, width_s, lateness_s)
    return (kept.groupBy("product_id", "window_start")
            .agg(total("rating").cast("long").alias("r"), total("likes").cast("long").alias("l"), F.count("*").alias("c"),
                 F.max("arrival_ts").alias("last_arrival")))


def add_partials(root: str, run: str, width_s: int, lateness_s: int) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: store what the batch adds, then publish the new totals of the windows it touched.

    Totals are sums over the run's stored partials, so there is no state, no watermark and no need of any order. Only
    the days that the batch touches are read, and of these as many files as the logarithm of their batches. A version is an update if its window was published before and the
    batch has a review that came after the window had closed. Reviews that cannot be placed go to `root`/_quarantine.
    """
    publish_versions = upsert_into(root, run)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, partials = batch.sparkSession, None
        batch.persist()
        try:
            _set_apart(unplaced(batch).withColumn("seen", F.coalesce("arrival_ts", "date", F.lit(0).cast("timestamp"))),
                       f"{root}/_quarantine", batch_id, run)
            partials = tumbling_partials(batch, width_s, lateness_s).persist()
            log = partial_log(spark, root, run)
            days = log.add(partials.select(*PARTIAL.fieldNames()), batch_id, "window_start")
            if not days:
                return
            earlier = log.read(days, before=batch_id).withColumn("last_arrival", F.lit(None).cast("timestamp"))
            totals = (partials.withColumn("own", F.lit(True)).unionByName(earlier.withColumn("own", F.lit(False)))
                      .groupBy("product_id", "window_start")
                      .agg(*[F.sum(c).alias(c) for c in "rlc"], F.max("last_arrival").alias("last_arrival"), F.bool_or("own").alias("own"))
                      .filter("own"))
            closed = F.col("window_start") + F.make_dt_interval(secs=F.lit(width_s))
            publish_versions(totals.select("product_id", "window_start",
                                           *finish_tumbling(F.col("r"), F.col("l"), F.col("c")),
                                           (F.col("last_arrival") > closed).alias("corrects")), batch_id)
        finally:
            batch.unpersist()
            if partials is not None:
                partials.unpersist()
    return write


def closing_windows(spark: SparkSession, root: str, width_s: int, as_of: datetime | str | None = None) -> DataFrame:
    """Windows of the table that had ended by `as_of`; all of them, open ones too, when the stream has stopped (None)."""
    windows = latest_windows(spark, root, WINDOW_AGG)
    return windows if as_of is None else closed_windows(windows, width_s, as_of)


def closed_windows(windows: DataFrame, width_s: int, as_of: datetime | str) -> DataFrame:
    """Windows that had ended by `as_of`; the table also holds the ones still filling up."""
    return windows.filter(F.col("window_start") + F.make_dt_interval(secs=F.lit(width_s))
                          <= F.lit(as_of).cast("timestamp"))


def upsert_into(root: str, run: str = "0") -> Callable[[DataFrame, int], None]:
    """foreachBatch body: flag corrections, then append the batch to the window table.

    Only the days the batch touches are read back. A repeated batch ignores
    what it wrote itself, so the flags come out the same.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            days = days_of(batch, "window_start")
            if not days:
                return
            earlier = before(read_versions(batch.sparkSession, root, WINDOW_AGG, days=days), run, batch_id)
            corrects = "corrects" if "corrects" in batch.columns else None
            marked = mark_updates(batch, earlier, corrects=corrects)
            append_batch(marked.select(*WINDOW_AGG.fieldNames()), root, batch_id, "window_start", run, WINDOW_KEY)
        finally:
            batch.unpersist()
    return write


def run_tumbling_table(reviews: DataFrame, root: str, checkpoint: str, width_s: int, lateness_s: int,
                       final: bool = False) -> StreamingQuery:
    run = run_of(reviews.sparkSession, checkpoint)
    writer = (reviews.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(add_partials(root, run, width_s, lateness_s)))
    return flush_every(writer, final=final).start()


PANE = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("pane", T.TimestampType()),
    T.StructField("c", T.LongType()), T.StructField("r", T.LongType()), T.StructField("neg", T.LongType()),
    T.StructField("newest", T.TimestampType())])


def run_sliding_panes(reviews: DataFrame, root: str, checkpoint: str, size_s: int = 300, slide_s: int = 60,
                      final: bool = False) -> StreamingQuery:
    """Store what each batch adds to the panes of the sliding windows; any order of reading gives the same windows."""
    check_sliding(size_s, slide_s)
    run = run_of(reviews.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(sliding_panes(batch, gcd(size_s, slide_s)).select(
            *[F.col(f.name).cast(f.dataType) for f in PANE.fields]), root, batch_id, "pane", run)

    return flush_every(reviews.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), final=final).start()


def sliding_windows(spark: SparkSession, root: str, run: str, size_s: int = 300, slide_s: int = 60,
                    closed_by: datetime | str | None = None) -> DataFrame:
    """Windows from the stored panes of a run: those closed by a time, or with None all, as published on stop."""
    panes = read_versions(spark, root, PANE).filter(F.col("run") == F.lit(run)).select(*PANE.fieldNames())
    windows = slide_panes(panes, size_s, slide_s)
    return windows if closed_by is None else windows.filter(F.col("window_end") <= F.lit(closed_by).cast("timestamp"))


SEEN = T.StructType([T.StructField("id", T.StringType()), T.StructField("arrival_ts", T.TimestampType()),
                     T.StructField("seq", T.LongType())])


def dedup_into(root: str, run: str, horizon_s: int = DEDUP_HORIZON_S) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: accept reviews whose id was not accepted within the horizon before, as `dedup_within` does.

    The log of accepted (id, arrival_ts, seq) is the memory; only its days that reach into the batch's horizon are read.
    The rule works on these three columns, the accepted rows are joined last. Accepted rows go to `root`/accepted,
    reviews without arrival to `root`/quarantine. Ids that come back are told apart exactly if batches come in the order
    of arrival; an id that occurs once is accepted in any order.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            _set_apart(batch.filter("arrival_ts is null").withColumn("seen", F.lit(0).cast("timestamp")),
                       f"{root}/quarantine", batch_id, run)
            dated = batch.filter("arrival_ts is not null")
            back = F.make_dt_interval(secs=F.lit(horizon_s))
            reach = {d for r in dated.select(F.to_date("arrival_ts").alias("d"), F.to_date(F.col("arrival_ts") - back).alias("e")).distinct().collect()
                     for d in _days_between(r.e, r.d)}
            log = LevelledLog(spark, f"{root}/log/run={run}", SEEN)
            past = log.read(reach, before=batch_id).withColumn("own", F.lit(False))
            both = dated.select(*SEEN.fieldNames(), F.lit(True).alias("own")).unionByName(past).persist()
            try:
                fresh = durable(first_within(both, horizon_s).filter("own").select(*SEEN.fieldNames()))
            finally:
                both.unpersist()
            same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("arrival_ts") == F.col("_at")) & F.col("seq").eqNullSafe(F.col("_seq"))
            accepted = dated.join(few_or_shuffled(fresh.toDF("_id", "_at", "_seq")), same, "left_semi").dropDuplicates(SEEN.fieldNames())  # rows may be repeated whole
            append_batch(accepted, f"{root}/accepted", batch_id, "arrival_ts", run)
            log.add(fresh, batch_id, "arrival_ts")
        finally:
            batch.unpersist()
    return write


def _days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def run_dedup(reviews: DataFrame, root: str, checkpoint: str, horizon_s: int = DEDUP_HORIZON_S,
              final: bool = False) -> StreamingQuery:
    run = run_of(reviews.sparkSession, checkpoint)
    writer = reviews.writeStream.option("checkpointLocation", checkpoint).foreachBatch(dedup_into(root, run, horizon_s))
    return flush_every(writer, final=final).start()


def stats_stream(reviews: DataFrame) -> DataFrame:
    """Cumulative statistics, for complete mode."""
    return review_stats(reviews)


def publish(messages: DataFrame, transport: str, options: dict[str, str], checkpoint: str,
            name: str = "published") -> DataStreamWriter:
    """Stream (key, value) rows out. Progress reports count what was published and what had no value."""
    counted = messages.observe(name, *publish_counters())
    return (counted.filter(F.col("value").isNotNull()).writeStream.format(transport).options(**options)
            .option("checkpointLocation", checkpoint))


def fan_out(*writes: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """foreachBatch body that feeds one batch to several writers, computing it once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for each in writes:
                each(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def alert_into(window_root: str, alert_root: str, recent_s: int = RECENT_S,
               cooldown_s: int = COOLDOWN_S, run: str = "0") -> Callable[[DataFrame, int], None]:
    """foreachBatch body: check the window table as of the batch's newest window, log alerts sent.

    The alert log is the cooldown memory: only its last `cooldown_s` seconds are
    read back, one row per product and rule. Call after upsert_into for the same batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = F.max("window_start")

        def day_before(seconds: int) -> Column:
            return F.to_date(newest - F.make_dt_interval(secs=F.lit(seconds)))

        as_of, today, recent_day, cooldown_day = batch.agg(
            F.date_format(newest, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.to_date(newest),
            day_before(recent_s), day_before(cooldown_s)).first()
        if as_of is None:
            return
        stamp = F.lit(as_of).cast("timestamp")
        # A batch may end before the table does, so later days are not cut off.
        windows = latest_windows(spark, window_root, WINDOW_AGG, recent_day)
        sent = before(read_versions(spark, alert_root, ALERT, cooldown_day, today), run, batch_id).filter(
            (F.col("sent_at") > stamp - F.make_dt_interval(secs=F.lit(cooldown_s))))
        due = (anomalies(windows, as_of, recent_s).withColumn("sent_at", stamp)
               .join(sent.select("product_id").distinct(), "product_id", "left_anti"))
        append_batch(due.select(*ALERT.fieldNames()), alert_root, batch_id, "sent_at", run)
    return write


def show_on_console(df: DataFrame, mode: str, rows: int = 20) -> DataStreamWriter:
    return df.writeStream.outputMode(mode).format("console").option("numRows", rows).option("truncate", False)
