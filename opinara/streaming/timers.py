"""Streams with keyed state and event-time timers: windows that close on time, and alerts that keep silent after one."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from opinara.operators.alerts import CHECK_EVERY_S, COOLDOWN_S, RECENT_S, anomaly_messages, check_scores, check_sums
from opinara.operators.scaling import running_totals
from opinara.operators.windows import classify_arrival, finish_tumbling
from opinara.sources.writers import append_batch, before, days_of, read_versions, run_of
from opinara.streaming.jobs import admissible, flush_every

STATE = "spark.sql.streaming.stateStore."
#: What streams with timers need: state on disk, and only changes written per batch.
STATE_STORE = {STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               STATE + "rocksdb.changelogCheckpointing.enabled": "true"}
#: A product's window is held in so many parts, so that one busy product does not fill one task.
SALTS = 8

HELD = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("start_us", T.LongType()), T.StructField("at_close", T.BooleanType()),
    T.StructField("at_us", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("r", T.LongType()),
    T.StructField("l", T.LongType()), T.StructField("c", T.LongType())])
#: A late review as it is kept in the state; `known` is false where seq is null.
LATE = np.dtype([("at_us", "<i8"), ("seq", "<i8"), ("r", "<i8"), ("l", "<i8"), ("known", "?")])
#: Most reviews of a block.
LATE_ROWS = 10_000
EMISSION = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("window_start", T.TimestampType()),
    T.StructField("emitted_at", T.TimestampType()), T.StructField("seq", T.LongType()), T.StructField("r", T.LongType()),
    T.StructField("l", T.LongType()), T.StructField("c", T.LongType()), T.StructField("is_update", T.BooleanType())])


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The settings that a stream with timers takes over when it starts."""
    before_ = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before_.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class HoldUntilDue(StatefulProcessor):
    """Part of one product's window: sums of on-time reviews until the window ends, late ones until all earlier arrivals are in.

    A row is due once the watermark has passed its time: then nothing that arrived before it can still come. Late reviews are
    held as packed blocks, one per batch of rows, and come out as arrays: what a review costs is a few bytes, not objects.
    """

    def __init__(self, width_s: int):
        self.width_us = width_s * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.on_time = handle.getValueState("on_time", "r long, l long, c long, seq long")
        self.late = handle.getListState("late", "block binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        r, l, c, seq = self.on_time.get() or (0, 0, 0, None)
        held, first, before_c = [], None, c
        for part in rows:
            on = part[~part["is_late"]]
            if len(on):
                r, l, c = r + int(on["r"].sum()), l + int(on["l"].sum()), c + len(on)
                known = on["seq"].dropna()
                if len(known):
                    seq = int(known.max()) if seq is None else max(seq, int(known.max()))
            after = part[part["is_late"]]
            for at in range(0, len(after), LATE_ROWS):
                block = packed_late(after.iloc[at:at + LATE_ROWS])
                held.append((block.tobytes(),))
                first = int(block["at_us"].min()) if first is None else min(first, int(block["at_us"].min()))
        if c > before_c:
            self.on_time.update((r, l, c, seq))
            self.handle.registerTimer((key[1] + self.width_us) // 1000)
        if held:
            self.late.appendList(held)
            self.handle.registerTimer(first // 1000)
        yield pd.DataFrame([], columns=HELD.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        product, start_us = key[0], key[1]
        passed = timerValues.getCurrentWatermarkInMs()
        closes = start_us + self.width_us
        sums = self.on_time.get()
        if sums is not None and closes // 1000 < passed:
            yield pd.DataFrame([(product, start_us, True, closes, sums[3], *sums[:3])], columns=HELD.names)
            self.on_time.clear()
        rest, waits, due = [], None, False
        for (data,) in self.late.get():
            block = np.frombuffer(data, LATE)
            now = block["at_us"] // 1000 < passed
            if now.any():
                due = True
                yield unpacked_late(product, start_us, block[now])
                block = block[~now]
            if len(block):
                rest.append((block.tobytes(),))
                waits = int(block["at_us"].min()) if waits is None else min(waits, int(block["at_us"].min()))
        if due:
            self.late.put(rest) if rest else self.late.clear()
        if rest:
            self.handle.registerTimer(waits // 1000)

    def close(self) -> None:
        pass


def packed_late(rows: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(rows), LATE)
    known = rows["seq"].notna().to_numpy()
    out["seq"] = 0
    out["seq"][known] = rows["seq"].to_numpy()[known].astype(np.int64)
    out["known"] = known
    for c in ("at_us", "r", "l"):
        out[c] = rows[c].to_numpy()
    return out


def unpacked_late(product: str | None, start_us: int, block: np.ndarray) -> pd.DataFrame:
    """Rows of HELD for some late reviews."""
    n = len(block)
    seq = pd.array(block["seq"].copy(), "Int64")
    seq[~block["known"]] = pd.NA
    return pd.DataFrame({"product_id": [product] * n, "start_us": np.full(n, start_us), "at_close": np.zeros(n, bool), "at_us": block["at_us"].copy(),
                         "seq": seq, "r": block["r"].copy(), "l": block["l"].copy(), "c": np.ones(n, np.int64)}, columns=HELD.names)


def due_rows(reviews: DataFrame, width_s: int, lateness_s: int, disorder_s: int, salts: int = SALTS) -> DataFrame:
    """What windows have to emit, each row once its time has come: sums at the end of a window (in up to `salts` parts), then
    one row per late review. `disorder_s`: so much later than a review that arrived after it a review may still be read."""
    kept, _ = admissible(reviews.withWatermark("arrival_ts", f"{disorder_s} seconds"), width_s, lateness_s)
    classed = classify_arrival(kept, width_s, lateness_s)
    rows = classed.select(
        "product_id", F.unix_micros("window_start").alias("start_us"), F.pmod(F.xxhash64("seq", "arrival_ts"), F.lit(salts)).alias("salt"),
        "arrival_ts", F.unix_micros("arrival_ts").alias("at_us"), "seq", (F.col("arrival_class") == "late").alias("is_late"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c[0]) for c in ("rating", "likes")])
    return (rows.groupBy("product_id", "start_us", "salt")
            .transformWithStateInPandas(HoldUntilDue(width_s), HELD, "append", "eventTime"))


def emit_into(root: str, run: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: turn due rows into emissions of running totals and append them to the log under `root`.

    A window's earlier totals come from the log's days that the batch touches. The first emission of a window
    (of any product) is no update, all later ones are. A repeated batch writes the same rows again.
    """
    group = ["product_id", "window_start"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        due = batch.select("product_id", F.timestamp_micros("start_us").alias("window_start"), "at_close",
                           F.timestamp_micros("at_us").alias("emitted_at"), "seq", "r", "l", "c").persist()
        try:
            days = days_of(due, "window_start")
            if not days:
                return
            closing = (due.filter("at_close").groupBy(*group, "at_close", "emitted_at")
                       .agg(F.max("seq").alias("seq"), *[F.sum(c).alias(c) for c in "rlc"]).select(due.columns))
            new = closing.unionByName(due.filter(~F.col("at_close"))).withColumn("new", F.lit(True))
            earlier = before(read_versions(spark, root, EMISSION, days=days), run, batch_id).filter(F.col("run") == F.lit(run))
            touched = due.select(*[F.col(c).alias(f"_{c}") for c in group]).distinct()
            last = earlier.groupBy(*group).agg(F.max_by(F.struct("r", "l", "c"), F.struct("emitted_at", "seq")).alias("sums"))
            carried = (last.join(touched, F.col("product_id").eqNullSafe(F.col("_product_id")) & (F.col("window_start") == F.col("_window_start")),
                                 "left_semi")
                       .select(*group, F.lit(False).alias("at_close"), F.col("window_start").alias("emitted_at"),
                               F.lit(None).cast("long").alias("seq"), "sums.r", "sums.l", "sums.c", F.lit(False).alias("new")))
            totals = running_totals(new.unionByName(carried), group, ["emitted_at", "seq"], ["r", "l", "c"]).filter("new")
            openers = (due.groupBy("window_start").agg(F.bool_or("at_close").alias("closed"), F.min(F.struct("emitted_at", "seq")).alias("first"))
                       .filter("not closed").join(earlier.select("window_start").distinct(), "window_start", "left_anti")
                       .select("window_start", "first.emitted_at", "first.seq", F.lit(True).alias("opens")))
            published = earlier.select("window_start").distinct().withColumn("known", F.lit(True))
            # Both have at most a row per window of the touched days, however many reviews or products there are.
            marked = (totals.join(F.broadcast(openers), ["window_start", "emitted_at", "seq"], "left")
                      .join(F.broadcast(published), "window_start", "left")).withColumn(
                "is_update", F.when(F.col("at_close"), False).otherwise(F.col("known").isNotNull() | F.col("opens").isNull()))
            rows = marked.select(*group, "emitted_at", "seq", *[F.col(f"running_{c}").alias(c) for c in "rlc"], "is_update")
            append_batch(rows, root, batch_id, "window_start", run)
        finally:
            due.unpersist()
    return write


def run_closing(reviews: DataFrame, root: str, checkpoint: str, width_s: int, lateness_s: int, disorder_s: int = 0,
                salts: int = SALTS, final: bool = False) -> StreamingQuery:
    """Publish every window when it ends and again after each late review, as `tumbling_changelog` does.

    Reviews may be read out of order by less than `disorder_s` of arrival time; Spark drops and counts those behind by
    more. Windows close as the stream's arrival time goes on: `end_mark` moves it past the end of a stream that has stopped.
    """
    run = run_of(reviews.sparkSession, checkpoint)
    with state_store(reviews.sparkSession):
        writer = (due_rows(reviews, width_s, lateness_s, disorder_s, salts).writeStream.outputMode("append")
                  .option("checkpointLocation", checkpoint).foreachBatch(emit_into(root, run)))
        return flush_every(writer, final=final).start()


def emitted(spark: SparkSession, root: str, run: str) -> DataFrame:
    """The log of a run in the columns of `tumbling_changelog`."""
    rows = read_versions(spark, root, EMISSION).filter(F.col("run") == F.lit(run))
    return rows.select("product_id", "window_start", "emitted_at", "seq", *finish_tumbling(F.col("r"), F.col("l"), F.col("c")), "is_update")


def end_mark(schema: T.StructType, newest: DataFrame, after_s: int) -> DataFrame:
    """A row without product, dated `after_s` after `newest` (one timestamp, column at); its own window never closes.

    Added to the source when it stops, it lets all windows before it close.
    """
    at = F.col("at") + F.make_dt_interval(secs=F.lit(after_s))
    return newest.filter("at is not null").select(*[
        (at if f.name in ("date", "arrival_ts") else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


# --- alerts -----------------------------------------------------------------

SENT = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("check_us", T.LongType()), T.StructField("mean_rating", T.DoubleType()),
    T.StructField("negative", T.LongType()), T.StructField("windows", T.LongType()), T.StructField("rule", T.StringType()),
    T.StructField("message", T.StringType())])
ALERT_LOG = T.StructType([SENT.fields[0], T.StructField("check_at", T.TimestampType()), *SENT.fields[2:]])


class KeepSilent(StatefulProcessor):
    """One product: the time of the last check that was sent. Both messages of a check share it.

    Its life ends by a timer of event time when the cooldown is over, so a replay behaves as the live stream did.
    """

    def __init__(self, cooldown_s: int):
        self.cooldown_us = cooldown_s * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.sent = handle.getValueState("sent", "check_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hits = pd.concat(list(rows)).sort_values("check_us", kind="stable")
        last = self.sent.get()
        last = first = None if last is None else last[0]
        due = {}
        for check in hits["check_us"].unique().tolist():
            due[check] = last is None or check >= last + self.cooldown_us
            last = check if due[check] else last
        if last != first:
            if first is not None:
                self.handle.deleteTimer((first + self.cooldown_us) // 1000)
            self.sent.update((last,))
            self.handle.registerTimer((last + self.cooldown_us) // 1000)
        out = hits[hits["check_us"].map(due)].assign(product_id=key[0])
        yield out[SENT.names]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.sent.clear()
        yield pd.DataFrame([], columns=SENT.names)

    def close(self) -> None:
        pass


def alerts_sent(windows: DataFrame, recent_s: int = RECENT_S, every_s: int = CHECK_EVERY_S, cooldown_s: int = COOLDOWN_S) -> DataFrame:
    """A stream of windows to the alerts that go out: checks of the recent stretch, then the cooldown.

    Windows come in the order of their start; a check is made once a window that starts after it is read.
    """
    stream = windows.withWatermark("window_start", "0 seconds")
    hops = F.window("window_start", f"{recent_s} seconds", f"{every_s} seconds")
    checks = check_sums(stream, hops).select("product_id", F.window_time("w").alias("seen_at"),
                                             F.unix_micros("w.end").alias("check_us"), *check_scores())
    hits = anomaly_messages(checks)
    return hits.groupBy("product_id").transformWithStateInPandas(KeepSilent(cooldown_s), SENT, "append", "eventTime")


def log_alerts(root: str, run: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("check_at", F.timestamp_micros("check_us")).select(*ALERT_LOG.names)
        append_batch(rows, root, batch_id, "check_at", run)
    return write


def run_alerts(windows: DataFrame, root: str, checkpoint: str, recent_s: int = RECENT_S, every_s: int = CHECK_EVERY_S,
               cooldown_s: int = COOLDOWN_S, final: bool = False) -> StreamingQuery:
    """Log the alerts of a stream of windows under `root`, as `alert_cooldown` over their history."""
    run = run_of(windows.sparkSession, checkpoint)
    with state_store(windows.sparkSession):
        writer = (alerts_sent(windows, recent_s, every_s, cooldown_s).writeStream.outputMode("append")
                  .option("checkpointLocation", checkpoint).foreachBatch(log_alerts(root, run)))
        return flush_every(writer, final=final).start()


def logged_alerts(spark: SparkSession, root: str, run: str) -> DataFrame:
    return read_versions(spark, root, ALERT_LOG).filter(F.col("run") == F.lit(run)).select(*ALERT_LOG.names)
