"""A stream over files in arrival order ends with what the batch operators compute."""

import os
import shutil
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opinara.operators import alerts, serving, stats, tables
from opinara.operators import windows as w
from opinara.plans import fixtures as fx
from opinara.schemas import WINDOW_AGG
from opinara.sources import codec, readers, writers
from opinara.streaming import jobs

COLUMNS = ["id", "product_id", "rating", "likes", "date", "arrival_ts", "seq"]
SCHEMA = "id string, product_id string, rating int, likes int, date timestamp, arrival_ts timestamp, seq long"
N_FILES = 6


@pytest.fixture(scope="module")
def reviews(spark, sf_small):
    return fx.reviews(spark, sf_small).select(*COLUMNS).cache()


@pytest.fixture(scope="module")
def files(spark, reviews, tmp_path_factory):
    """One file per stretch of arrival time, with rising modification times."""
    root, parts = tmp_path_factory.mktemp("arrivals"), tmp_path_factory.mktemp("parts")
    reviews.repartitionByRange(N_FILES, "arrival_ts").sortWithinPartitions("arrival_ts").write.mode(
        "overwrite").parquet(str(parts))
    for i, part in enumerate(sorted(Path(parts).glob("part-*.parquet"))):
        target = root / f"{i:03d}.parquet"
        shutil.copy(part, target)
        os.utime(target, (time.time() - 1000 + i, time.time() - 1000 + i))
    return str(root)


def stream(spark, files):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(files)


def drain(writer, path):
    query = jobs.flush_every(writer.option("checkpointLocation", str(path / "state")), final=True).start()
    query.awaitTermination()
    return query


def sorted_rows(df):
    return sorted(map(tuple, df.collect()))


def test_tumbling_table_equals_batch(spark, reviews, files, tmp_path):
    query = jobs.run_tumbling_table(stream(spark, files), str(tmp_path / "t"), str(tmp_path / "s"),
                                    fx.WIDTH_S, fx.LATENESS_S, final=True)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == N_FILES
    got = writers.latest_windows(spark, str(tmp_path / "t"), WINDOW_AGG)
    kept = w.classify_arrival(reviews, fx.WIDTH_S, fx.LATENESS_S).filter("arrival_class <> 'dropped'")
    assert sorted_rows(serving.serve_projection(got)) == sorted_rows(w.tumbling(kept, fx.WIDTH_S))
    versions = writers.read_versions(spark, str(tmp_path / "t"), WINDOW_AGG)
    # An update needs an earlier version of its window and a review from after the window closed.
    first = versions.groupBy("window_start").agg(F.min("batch_id").alias("first"))
    updates = versions.filter("is_update")
    assert updates.count() > 0
    assert updates.join(first, "window_start").filter("batch_id <= first").count() == 0
    on_time = (w.classify_arrival(reviews, fx.WIDTH_S, fx.LATENESS_S)
               .groupBy("product_id", "window_start").agg(F.count_if(F.col("arrival_class") == "late").alias("late")))
    assert updates.join(on_time.filter("late = 0"), ["product_id", "window_start"]).count() == 0


def test_open_windows_can_be_left_out(spark, reviews):
    windows = w.tumbling(reviews, fx.WIDTH_S)
    as_of = "2024-01-10 13:00:00"
    got = jobs.closed_windows(windows, fx.WIDTH_S, as_of).agg(F.max("window_start").cast("string")).first()[0]
    assert got == "2024-01-10 06:00:00"


def test_order_of_reading_does_not_matter(spark, reviews, tmp_path):
    """Files that hold the products one after the other, one per trigger."""
    reviews.repartition(6, "product_id").sortWithinPartitions("arrival_ts").write.parquet(str(tmp_path / "in"))
    jobs.run_tumbling_table(stream(spark, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "s"),
                            fx.WIDTH_S, fx.LATENESS_S, final=True).awaitTermination()
    kept = w.classify_arrival(reviews, fx.WIDTH_S, fx.LATENESS_S).filter("arrival_class <> 'dropped'")
    got = jobs.closing_windows(spark, str(tmp_path / "t"), fx.WIDTH_S)
    assert sorted_rows(serving.serve_projection(got)) == sorted_rows(w.tumbling(kept, fx.WIDTH_S))
    closed = jobs.closing_windows(spark, str(tmp_path / "t"), fx.WIDTH_S, "2024-01-10 13:00:00")
    assert 0 < closed.count() < got.count()


def test_a_new_run_wins_only_where_it_writes(spark, tmp_path):
    root = str(tmp_path / "t")

    def batch(*rows):
        return spark.createDataFrame([(p, f"2024-01-0{d} 00:00:00", float(v), 0, 1) for p, d, v in rows],
                                     "product_id string, start string, avg_rating double, total_likes long, review_count long") \
            .select("product_id", F.col("start").cast("timestamp").alias("window_start"), "avg_rating", "total_likes", "review_count")

    first, second = (jobs.upsert_into(root, writers.run_of(spark, str(tmp_path / name))) for name in ("a", "b"))
    first(batch(("y", 1, 5), ("x", 1, 1)), 0)
    first(batch(("z", 2, 6), ("x", 1, 2)), 1)
    second(batch(("x", 1, 9)), 0)
    got = {r.product_id: r.avg_rating for r in writers.latest_windows(spark, root, WINDOW_AGG).collect()}
    assert got == {"y": 5, "z": 6, "x": 9}
    assert writers.run_of(spark, str(tmp_path / "a")) == writers.run_of(spark, str(tmp_path / "a")) < writers.run_of(spark, str(tmp_path / "b"))
    writers.compact_windows(spark, root, WINDOW_AGG, str(tmp_path / "small"))
    again = writers.latest_windows(spark, str(tmp_path / "small"), WINDOW_AGG)
    assert {r.product_id: r.avg_rating for r in again.collect()} == got


def test_repeated_batch_changes_nothing(spark, reviews, tmp_path):
    root = str(tmp_path / "t")
    write = jobs.upsert_into(root)
    batches = [w.tumbling(reviews.filter(F.col("seq") < n), fx.WIDTH_S) for n in (300, 700)]
    write(batches[0], 0)
    write(batches[1], 1)
    before = sorted_rows(writers.latest_windows(spark, root, WINDOW_AGG))
    write(batches[1], 1)
    assert sorted_rows(writers.latest_windows(spark, root, WINDOW_AGG)) == before
    write(batches[1].limit(0), 2)
    assert sorted_rows(writers.latest_windows(spark, root, WINDOW_AGG)) == before


def test_reviews_without_dates_are_set_apart_and_future_ones_kept(spark, reviews):
    odd = reviews.withColumns({
        "arrival_ts": F.when(F.col("seq") % 100 == 0, F.col("date") - F.expr("interval 1 hour"))
                       .when(F.col("seq") % 100 == 1, F.lit(None)).otherwise(F.col("arrival_ts")),
        "date": F.when(F.col("seq") % 100 != 2, F.col("date"))})
    kept, unplaced = jobs.admissible(odd, fx.WIDTH_S, fx.LATENESS_S)
    assert kept.filter("date > arrival_ts").count() == 10
    assert {(r.reason, r["count"]) for r in unplaced.groupBy("reason").count().collect()} == {("no_date", 10), ("no_arrival", 10)}
    fates = {r.fate: r.n for r in w.reviews_by_fate(odd, fx.WIDTH_S, fx.LATENESS_S).collect()}
    assert sum(fates.values()) == odd.count() and fates["on_time"] + fates["late"] == kept.count()


def test_unplaced_reviews_reach_the_quarantine(spark, reviews, tmp_path):
    reviews.withColumn("date", F.when(F.col("seq") % 10 != 0, F.col("date"))).write.parquet(str(tmp_path / "in"))
    jobs.run_tumbling_table(stream(spark, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "s"),
                            fx.WIDTH_S, fx.LATENESS_S, final=True).awaitTermination()
    lost = spark.read.parquet(str(tmp_path / "t" / "_quarantine"))
    assert lost.count() == 100 and {r.reason for r in lost.select("reason").distinct().collect()} == {"no_date"}


def test_restart_continues_from_the_checkpoint(spark, files, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    names = sorted(Path(files).glob("*.parquet"))
    run = lambda: jobs.run_tumbling_table(
        stream(spark, str(source)), str(tmp_path / "t"), str(tmp_path / "s"), fx.WIDTH_S, fx.LATENESS_S, final=True)
    for group in (names[:3], names[3:]):
        for name in group:
            shutil.copy2(name, source / name.name)
        run().awaitTermination()
    whole = jobs.run_tumbling_table(stream(spark, files), str(tmp_path / "t2"), str(tmp_path / "s2"),
                                    fx.WIDTH_S, fx.LATENESS_S, final=True)
    whole.awaitTermination()
    read = lambda root: sorted_rows(serving.serve_projection(
        writers.latest_windows(spark, str(tmp_path / root), WINDOW_AGG)))
    assert read("t") == read("t2")


def test_sliding_panes_give_all_windows(spark, reviews, tmp_path):
    reviews.repartition(5, "product_id").write.parquet(str(tmp_path / "in"))
    jobs.run_sliding_panes(stream(spark, str(tmp_path / "in")), str(tmp_path / "panes"), str(tmp_path / "s"), fx.SIZE_S, fx.SLIDE_S,
                           final=True).awaitTermination()
    run = writers.run_of(spark, str(tmp_path / "s"))
    expected = w.sliding(reviews, fx.SIZE_S, fx.SLIDE_S)
    got = jobs.sliding_windows(spark, str(tmp_path / "panes"), run, fx.SIZE_S, fx.SLIDE_S)
    assert sorted_rows(got) == sorted_rows(expected)
    closed = jobs.sliding_windows(spark, str(tmp_path / "panes"), run, fx.SIZE_S, fx.SLIDE_S, "2024-01-10 13:00:00")
    assert 0 < closed.count() < expected.count()


def test_published_messages_are_counted(spark, files, tmp_path):
    messages = codec.encode_raw(stream(spark, files))
    writer = jobs.publish(messages, "json", {"path": str(tmp_path / "out")}, str(tmp_path / "state"))
    query = jobs.flush_every(writer, final=True).start()
    query.awaitTermination()
    counts = [p["observedMetrics"]["published"] for p in query.recentProgress if "published" in p["observedMetrics"]]
    assert sum(c["published"] for c in counts) == 1000 and sum(c["failed"] for c in counts) == 0
    assert spark.read.schema(readers.MESSAGE).json(str(tmp_path / "out")).count() == 1000


def test_stats_stream_equals_batch(spark, reviews, files, tmp_path):
    seen = []
    drain(jobs.stats_stream(stream(spark, files)).writeStream.outputMode("complete")
          .foreachBatch(lambda batch, _: seen.append(tuple(batch.first()))), tmp_path)
    assert len(seen) == N_FILES
    assert seen[-1] == tuple(stats.review_stats(reviews).first())


def dedup(spark, source, path, horizon_s=jobs.DEDUP_HORIZON_S):
    jobs.run_dedup(source, str(path / "d"), str(path / "s"), horizon_s, final=True).awaitTermination()
    return spark.read.parquet(str(path / "d" / "accepted"))


def test_dedup_stream_drops_copies_inside_the_horizon(spark, files, tmp_path):
    twice = stream(spark, files).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    got = dedup(spark, twice, tmp_path)
    assert (got.count(), got.select("id").distinct().count()) == (1000, 1000)


def test_dedup_stream_keeps_single_ids_in_any_order(spark, reviews, tmp_path):
    odd = reviews.withColumn("arrival_ts", F.when(F.col("seq") != 7, F.col("arrival_ts")))
    odd.repartition(6, "product_id").write.parquet(str(tmp_path / "in"))
    assert dedup(spark, stream(spark, str(tmp_path / "in")), tmp_path).count() == 999
    assert spark.read.parquet(str(tmp_path / "d" / "quarantine")).count() == 1


def test_dedup_of_a_repeated_batch_changes_nothing(spark, reviews, tmp_path):
    again = reviews.withColumn("id", F.concat_ws("-", "product_id", (F.col("seq") % 3).cast("string")))
    write = jobs.dedup_into(str(tmp_path / "d"), "r", 6 * fx.HOUR)
    for n in (0, 1, 1):
        write(again.filter((F.col("arrival_ts") >= "2024-01-15") == F.lit(bool(n))), n)
    got = spark.read.parquet(str(tmp_path / "d" / "accepted")).select("id", "arrival_ts")
    assert sorted_rows(got) == sorted_rows(tables.dedup_within(again, 6 * fx.HOUR).select("id", "arrival_ts"))


def test_fan_out_feeds_every_writer(spark, files, tmp_path):
    def as_messages(batch, batch_id):
        writers.write_messages(codec.encode_raw(batch), "json", {"path": str(tmp_path / "raw")})

    def as_windows(batch, batch_id):
        writers.append_batch(w.tumbling(batch, fx.WIDTH_S).withColumn("is_update", F.lit(False)),
                             str(tmp_path / "win"), batch_id, "window_start")

    drain(stream(spark, files).writeStream.foreachBatch(jobs.fan_out(as_messages, as_windows)), tmp_path)
    assert spark.read.schema(readers.MESSAGE).json(str(tmp_path / "raw")).count() == 1000
    assert writers.read_versions(spark, str(tmp_path / "win"), WINDOW_AGG).agg(
        F.sum("review_count")).first()[0] == 1000


def test_message_streams_decode_and_set_empty_apart(spark, reviews, tmp_path):
    messages = codec.encode_windowed(w.tumbling(reviews, fx.WIDTH_S))
    messages.unionByName(spark.createDataFrame([("k", "{broken"), ("k", None)], readers.MESSAGE)) \
        .coalesce(2).write.json(str(tmp_path / "in"))
    decoded = readers.window_stream(spark, "json", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"})
    drain(decoded.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path)
    good, bad = codec.split_corrupt(spark.read.schema(decoded.schema).parquet(str(tmp_path / "out")))
    assert sorted(r.value for r in bad.collect()) == ["", "{broken"]
    expected = w.tumbling(reviews, fx.WIDTH_S)
    assert sorted_rows(good.select(*expected.columns)) == sorted_rows(expected)


def test_alerts_follow_the_table_and_stay_silent_in_the_cooldown(spark, files, tmp_path):
    table, log = str(tmp_path / "t"), str(tmp_path / "alerts")
    def alert(batch, batch_id):
        windows = w.classify_arrival(batch, fx.WIDTH_S, fx.LATENESS_S).filter("arrival_class <> 'dropped'")
        jobs.alert_into(table, log, fx.RECENT_S, 2 * fx.DAY)(windows, batch_id)

    both = jobs.fan_out(jobs.add_partials(table, "0", fx.WIDTH_S, fx.LATENESS_S), alert)
    drain(stream(spark, files).writeStream.foreachBatch(both), tmp_path)
    sent = writers.read_versions(spark, log, jobs.ALERT)
    assert sent.count() > 0
    times = sent.select("product_id", F.unix_seconds("sent_at").alias("t")).distinct().collect()
    by_product = {}
    for r in times:
        by_product.setdefault(r.product_id, []).append(r.t)
    assert all(b - a >= 2 * fx.DAY for ts in by_product.values() for a, b in zip(sorted(ts), sorted(ts)[1:]))
    versions = writers.read_versions(spark, table, WINDOW_AGG)
    first = versions.filter("batch_id = 0")
    as_of = first.agg(F.max("window_start").cast("string")).first()[0]
    assert sorted_rows(sent.filter("batch_id = 0").select("product_id", "rule")) == sorted_rows(
        alerts.anomalies(first, as_of, fx.RECENT_S).select("product_id", "rule"))


def test_console_stream_runs(spark, files, tmp_path):
    writer = jobs.show_on_console(jobs.stats_stream(stream(spark, files)), "complete", rows=1)
    query = jobs.flush_every(writer.option("checkpointLocation", str(tmp_path / "state")), final=True).start()
    assert query.awaitTermination(120)


def test_flush_size_is_a_source_option():
    options = readers.kafka_options("broker:9092", readers.WINDOW_TOPIC, "latest", per_batch=jobs.FLUSH_ROWS)
    assert (options["maxOffsetsPerTrigger"], options["startingOffsets"], options["failOnDataLoss"]) == ("100", "latest", "true")
    assert "maxOffsetsPerTrigger" not in readers.kafka_options("broker:9092", readers.RAW_TOPIC, "earliest")
