import pyarrow as pa
from pyspark.sql import functions as F

from opinara.plans import catalog
from opinara.sources import messages, texts

SCHEMA = "doc_id long, body string"


def test_texts_come_back_whole_and_in_the_order_of_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(texts, "OPEN_FILES", 2)
    root = str(tmp_path / "texts")
    bodies = ["", None, "żółć 🙂 " * 3, "x" * 3_000_000, "line\nline\r\n\ttab \x00"] + [f"text {i} " * (i % 90) for i in range(400)]
    rows = spark.createDataFrame(list(enumerate(bodies)), SCHEMA).repartition(5)
    places = texts.keep(rows, "body", root)
    assert places.columns == ["doc_id", *texts.PLACE.fieldNames()] and places.filter("text_size is null").count() == 1
    wanted = places.crossJoin(spark.range(3)).withColumn("mix", F.xxhash64("doc_id", "id")).orderBy("mix").coalesce(1)
    got = texts.fetch(wanted, root, "body")
    assert got.columns == ["doc_id", "id", "mix", "body"]
    got = got.collect()
    assert [r.mix for r in got] == sorted(r.mix for r in got) and len(got) == 3 * len(bodies)
    assert all(r.body == bodies[r.doc_id] for r in got)
    texts.drop(spark, root)
    assert not (tmp_path / "texts").exists()


def test_no_texts_at_all(spark, tmp_path):
    places = texts.keep(spark.createDataFrame([], SCHEMA), "body", str(tmp_path / "texts"))
    assert texts.fetch(places, str(tmp_path / "texts"), "body").collect() == []


def test_parts_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(texts, "BATCH_BYTES", 100)
    sizes = [10, None, 60, 500, 1, 40, 70, None]
    batch = pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32())], names=["text_size"])
    parts = [p.column("text_size").to_pylist() for p in texts.by_bytes(batch)]
    assert [s for p in parts for s in p] == sizes
    assert all(sum(s or 0 for s in p[1:]) < 100 for p in parts) and len(parts) > 2
    assert list(texts.by_bytes(batch.slice(0, 0))) == []


def tables(spark, tmp_path, n_events, n_docs, times):
    """Events, one without id, and documents of `times` 320 characters, one of them without text and one id twice."""
    folder = tmp_path / "tables"
    i = F.col("id")
    (spark.range(n_events).select(
        F.when(i != 5, i).alias("event_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=i.cast("int"))).alias("ts"),
        (i * 7 % 50).alias("user_id"), F.lit("view").alias("event_type"), (i % 90 + 0.5).alias("value"), F.lit('{"k": 3}').alias("props"))
     .write.parquet(str(folder / "events.parquet")))
    noise = F.concat(*[F.sha2(F.concat_ws("-", i, F.lit(k)), 256) for k in range(5)])
    (spark.range(n_docs).select(F.when(i == n_docs - 1, 7).otherwise(i).alias("doc_id"), F.when(i != 3, F.repeat(noise, times)).alias("text"))
     .write.parquet(str(folder / "documents.parquet")))
    return str(folder)


def test_texts_beyond_any_broadcast_are_not_shuffled(spark, tmp_path, monkeypatch):
    """71 MB of texts in 70 documents: rows are put in order with the place of their text."""
    monkeypatch.setattr(messages, "STRETCH_ROWS", 500)
    sf = tables(spark, tmp_path, 2000, 70, 3200)
    sent, attach = catalog._review_messages(spark, sf, str(tmp_path / "texts"))
    assert not {"body", "text", "value"} & set(sent.columns)
    plan = messages.in_topic_order(sent, ["seq"], 8, attach, weight="text_size")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("rangepartitioning") and "body" not in plan[plan.index("rangepartitioning"):]


def test_a_message_is_not_stored_in_topic_and_table(spark, tmp_path, monkeypatch):
    """What was decoded is gone from the topic but for the last segments, the texts are gone, and the rows are those of the batch query."""
    monkeypatch.setattr(messages, "STRETCH_ROWS", 200)
    root = tmp_path / "run"
    monkeypatch.setattr(catalog, "_fresh", lambda spark: str(root))
    sf = tables(spark, tmp_path, 3000, 60, 1)
    got = catalog.CATALOG["stream_messages"](spark, sf)
    wanted = catalog.CATALOG["json_quarantine"](spark, sf).drop("seq")
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty() and got.count() > 2900
    topic = messages.Topic(str(root / "topic"))
    assert all(len(paths) == 1 for paths in topic.segments.values()) and sum(topic.ends().values()) == got.count()
    kept = sum(f.stat().st_size for f in (root / "topic").rglob("*.parquet"))
    assert kept < sum(f.stat().st_size for f in (root / "out").glob("*.parquet")) / 2
    assert not (root / "texts").exists()
