import json

import pytest
from pyspark.sql import functions as F

from opinara.schemas import SLIDING_AGG, WINDOW_AGG
from opinara.sources import messages, readers, writers
from opinara.streaming import jobs


def numbered(spark, n, start=0):
    """Half of the messages have one key, some have none, some have no value."""
    i = F.col("id")
    return spark.range(start, start + n).select(
        F.when(i % 2 == 0, "hot").when(i % 11 == 0, None).otherwise(F.concat(F.lit("k"), i % 5)).alias("key"),
        F.when(i % 7 != 0, F.concat(F.lit('{"id": "'), i, F.lit('"}'))).alias("value"), i.alias("at"))


def collected(spark, root, checkpoint, **options):
    """All records and the size of every batch."""
    sizes, rows = [], []

    def keep(batch, batch_id):
        got = batch.collect()
        sizes.append(len(got))
        rows.extend(got)

    stream = readers.message_stream(spark, "messages", readers.topic_options(root, **options))
    jobs.drain(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep).trigger(processingTime="0 seconds").start())
    return rows, [s for s in sizes if s]


def test_polls_are_bounded_and_positions_survive_a_restart(spark, tmp_path):
    root, state = str(tmp_path / "topic"), str(tmp_path / "state")
    assert messages.append_messages(numbered(spark, 1200), root, ["at"], partitions=3, segment_rows=100) == 1200
    rows, sizes = collected(spark, root, state)
    assert sizes == [500, 500, 200]
    assert collected(spark, root, state)[0] == []
    messages.append_messages(numbered(spark, 70, start=1200), root, ["at"], partitions=3)
    more, sizes = collected(spark, root, state, per_batch=30)
    assert sizes == [30, 30, 10]
    expected = [(r.key, r.value) for r in numbered(spark, 1270).collect()]
    assert sorted(((r.key, r.value) for r in rows + more), key=str) == sorted(expected, key=str)
    places = {}
    for r in rows + more:
        places.setdefault(r.partition, []).append(r.offset)
    assert all(sorted(o) == list(range(len(o))) for o in places.values())


def test_messages_of_a_key_keep_their_order(spark, tmp_path):
    root = str(tmp_path / "topic")
    messages.append_messages(numbered(spark, 3000).repartition(6), root, ["at"], partitions=2, segment_rows=64)
    rows, _ = collected(spark, root, str(tmp_path / "state"), per_batch=0)
    of_key = {}
    for r in sorted(rows, key=lambda r: (r.partition, r.offset)):
        if r.value is not None and r.key is not None:
            of_key.setdefault(r.key, []).append(int(json.loads(r.value)["id"]))
    assert len(of_key["hot"]) > 1000 and all(ids == sorted(ids) for ids in of_key.values())


def test_a_latest_start_skips_what_is_there(spark, tmp_path):
    root = str(tmp_path / "topic")
    messages.append_messages(numbered(spark, 40), root, ["at"])
    assert collected(spark, root, str(tmp_path / "late"), start="latest")[0] == []
    messages.append_messages(numbered(spark, 5, start=40), root, ["at"])
    rows, _ = collected(spark, root, str(tmp_path / "late"), start="latest")
    assert sorted(r.value for r in rows if r.value) == [f'{{"id": "{i}"}}' for i in (40, 41, 43, 44)]


def test_a_topic_that_is_not_there_yet(spark, tmp_path):
    assert collected(spark, str(tmp_path / "none"), str(tmp_path / "state"))[0] == []


def test_deleted_records_end_the_query(spark, tmp_path):
    root = tmp_path / "topic"
    messages.append_messages(numbered(spark, 50), str(root), ["at"], partitions=1, segment_rows=10)
    begin = messages.Topic(str(root)).begins()["0"]
    first = sorted((root / "partition=0").glob("*.parquet"))[0]
    first.rename(tmp_path / "gone.parquet")
    topic = messages.Topic(str(root))
    assert topic.begins()["0"] > begin
    with pytest.raises(ValueError):
        topic.slices("0", begin, 50)


def test_shares_add_up():
    assert messages.shares({"0": 3, "1": 4}, 10) == {"0": 3, "1": 4}
    got = messages.shares({"0": 1000, "1": 10, "2": 0, "3": 1}, 500)
    assert sum(got.values()) == 500 and got["2"] == 0 and got["3"] <= 1 and got["1"] <= 10


def test_a_slice_reads_no_more_than_its_records(spark, tmp_path):
    root = str(tmp_path / "topic")
    messages.append_messages(numbered(spark, 300), root, ["at"], partitions=1, segment_rows=100)
    slices = messages.Topic(root).slices("0", 90, 210)
    assert [(s.first, s.last) for s in slices][0][0] == 90 and slices[-1].last == 210
    assert sum(s.last - s.first for s in slices) == 120
    read = [o for s in slices for b in messages.MessageReader({"path": root}).read(s) for o in b.column("offset").to_pylist()]
    assert read == list(range(90, 210))


def window_message(product, minute, count):
    value = json.dumps({"product_id": product, "window_start": f"2024-01-02T03:{minute:02d}:00Z", "avg_rating": 4.0,
                        "total_likes": 1, "review_count": count, "is_update": False})
    return f"{product}-{minute}", value, count


def test_flush_by_rows_or_on_stop(spark, tmp_path):
    """Full buffers of rows are flushed, the rest waits for its time or for the stop; a window's last message counts."""
    root, state, table = (str(tmp_path / n) for n in ("topic", "state", "table"))
    sent = [window_message("a", m, m + 1) for m in range(45)] + [window_message("a", 0, 100)]
    sent += [("x", "{broken", 101)]
    messages.append_messages(spark.createDataFrame(sent, "key string, value string, at long"), root, ["at"], partitions=2)
    sizes = []
    write = jobs.upsert_into(table)

    def seen(batch, batch_id):
        sizes.append(batch.count())
        write(batch, batch_id)

    jobs.drain(jobs.run_flushed(spark, root, state, seen, rows=20, seconds=3600))
    assert len(sizes) == 2 and sum(sizes) <= 40
    jobs.drain(jobs.run_flushed(spark, root, state, seen, rows=20, seconds=0))
    assert len(sizes) == 3
    got = {r.window_start.minute: r.review_count for r in writers.latest_windows(spark, table, WINDOW_AGG).collect()}
    assert got == {0: 100} | {m: m + 1 for m in range(1, 45)}


def test_sliding_messages_without_value_are_kept_apart(spark, tmp_path):
    root, out = str(tmp_path / "topic"), str(tmp_path / "out")
    sent = [("a", '{"product_id": "a", "review_count": 2}', 1), ("a", None, 2), ("a", "nope", 3)]
    messages.append_messages(spark.createDataFrame(sent, "key string, value string, at long"), root, ["at"])
    jobs.drain(jobs.run_decoded(spark, root, out, str(tmp_path / "state"), SLIDING_AGG))
    got = spark.read.parquet(out).select("product_id", "_corrupt_record").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", None), (None, ""), (None, "nope")], key=str)


def test_an_empty_append_publishes_nothing(spark, tmp_path):
    root, out = str(tmp_path / "topic"), str(tmp_path / "out")
    assert messages.append_messages(numbered(spark, 0), root, ["at"]) == 0
    jobs.drain(jobs.run_decoded(spark, root, out, str(tmp_path / "state")))
    assert spark.read.schema("id string").parquet(out).count() == 0
    assert messages.append_messages(numbered(spark, 3), root, ["at"]) == 3
    assert messages.append_messages(numbered(spark, 4), root, ["at"]) == 4
    assert sum(messages.Topic(root).ends().values()) == 7


def test_values_are_attached_after_rows_are_placed(spark, tmp_path, monkeypatch):
    """Only keys and what orders them are shuffled; the order of a key and all values are as without `attach`."""
    monkeypatch.setattr(messages, "STRETCH_ROWS", 1000)
    root = str(tmp_path / "topic")
    texts = spark.range(7).select(F.col("id").alias("which"), F.concat(F.lit("text "), "id").alias("body"))
    rows = numbered(spark, 3000).repartition(6).drop("value").withColumn("which", F.col("at") % 7)

    def attach(placed):
        assert "value" not in placed.columns
        return placed.join(F.broadcast(texts), "which").withColumn("value", F.concat_ws("/", "at", "body"))

    plan = messages.in_topic_order(rows, ["at"], 2, attach)._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.index("BroadcastHashJoin") < plan.index("rangepartitioning") and plan.count("rangepartitioning") == 1
    assert "hashpartitioning" not in plan
    assert messages.append_messages(rows, root, ["at"], partitions=2, segment_rows=64, attach=attach) == 3000
    got, _ = collected(spark, root, str(tmp_path / "state"), per_batch=0)
    assert sorted((r.key or "", r.value) for r in got) == sorted((r.key or "", f"{r.at}/text {r.at % 7}") for r in rows.collect())
    of_key = {}
    for r in sorted(got, key=lambda r: (r.partition, r.offset)):
        of_key.setdefault(r.key, []).append(int(r.value.split("/")[0]))
    assert len(of_key["hot"]) > 1000 and all(at == sorted(at) for k, at in of_key.items() if k)


def test_texts_that_repeat_are_stored_once_in_a_file(spark, tmp_path):
    root, out = str(tmp_path / "topic"), tmp_path / "out"
    which = F.floor(F.col("id") / 2) % 1500  # 1.9 MB of different texts, 31 MB of texts
    noise = F.concat(*[F.sha2(F.concat_ws("-", which, F.lit(k)), 512) for k in range(10)])
    sent = spark.range(24_000).select(F.lit("a").alias("key"), "id", F.to_json(F.struct(F.col("id").cast("string").alias("id"), noise.alias("text"))).alias("value"))
    messages.append_messages(sent, root, ["id"], partitions=1)
    jobs.drain(jobs.run_decoded(spark, root, str(out), str(tmp_path / "state"), per_batch=0))
    assert spark.read.parquet(str(out)).select("text").distinct().count() == 1500
    assert sum(f.stat().st_size for f in out.glob("*.parquet")) < 5e6


def test_a_last_reader_deletes_what_it_has_read(spark, tmp_path):
    """Whole segments of batches that are done; the last one of a partition stays, so offsets go on and so does the query."""
    root, out, state = str(tmp_path / "topic"), str(tmp_path / "out"), str(tmp_path / "state")

    def go(first, last):
        rows = spark.range(first, last).select(F.lit("a").alias("key"), F.to_json(F.struct(F.col("id").cast("string").alias("id"))).alias("value"), "id")
        messages.append_messages(rows, root, ["id"], partitions=1, segment_rows=10)
        stream = jobs.run_decoded(spark, root, out, state, per_batch=35, delete_read=True)
        stream.processAllAvailable()
        kept = messages.Topic(root).segments["0"]
        jobs.drain(stream, read_topic=root)
        return kept

    before_stop = go(0, 100)
    assert 1 < len(before_stop) <= 4  # the last batch is not yet told
    topic = messages.Topic(root)
    assert len(topic.segments["0"]) == 1 and topic.ends() == {"0": 100}
    assert not [f for f in (tmp_path / "topic").rglob(".*.crc") if not (f.parent / f.name[1:-4]).exists()]
    go(100, 163)
    assert messages.Topic(root).ends() == {"0": 163} and len(messages.Topic(root).segments["0"]) == 1
    assert sorted(int(r.id) for r in spark.read.parquet(out).select("id").collect()) == list(range(163))


def test_records_that_were_not_read_are_not_deleted(spark, tmp_path):
    root = str(tmp_path / "topic")
    messages.append_messages(numbered(spark, 100), root, ["at"], partitions=1, segment_rows=10)
    first = messages.Topic(root).segments["0"]
    messages.delete_records(root, {"0": 25, "9": 5})
    bases = [int(p.rsplit("/", 1)[1].split(".")[0]) for p in messages.Topic(root).segments["0"]]
    assert bases[0] <= 25 < bases[1] and len(bases) < len(first)
    messages.delete_records(root, {})
    assert len(messages.Topic(root).segments["0"]) == len(bases)


def test_heavy_values_make_more_stretches(spark):
    rows = numbered(spark, 100).drop("value").withColumn("size", F.lit(10_000_000))
    attach = lambda placed: placed.withColumn("value", F.lit("v"))
    tasks = [messages.in_topic_order(rows, ["at"], 2, attach, weight).rdd.getNumPartitions() for weight in (None, "size")]
    assert tasks == [1, -(-1_000_000_000 // messages.STRETCH_BYTES)]
