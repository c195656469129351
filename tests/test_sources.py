import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.schemas import REVIEW, SLIDING_AGG, WINDOW_AGG, WINDOW_SERVED
from opinara.sources import codec, readers, writers
from tests.conftest import at


def review(spark, **changes):
    row = {"id": "src-1", "product_id": "WB-001", "rating": 5, "text": "good", "likes": 3, "dislikes": 1,
           "date": at("2024-01-02 03:04:05.25"), **changes}
    return spark.createDataFrame([tuple(row.values())], REVIEW)


@pytest.mark.parametrize("changes", [
    {}, {"text": ""}, {"likes": -5}, {"text": "ж\n\"\\\t😀" * 2000}, {"id": "x" * 10000}, {"rating": None}])
def test_review_round_trip(spark, changes):
    df = review(spark, **changes)
    message = codec.encode_raw(df)
    assert message.first().key == "WB-001"
    back = codec.decode_json(message.drop("key"), REVIEW)
    assert back.drop(codec.CORRUPT).collect() == df.collect()
    assert back.first()[codec.CORRUPT] is None


def test_window_message_has_its_identity(spark):
    df = spark.createDataFrame([("WB-001", at("2024-01-02 03:04"), 4.25, 42, 10, False)], WINDOW_AGG)
    got = codec.encode_windowed(df).first()
    ns = int(dt.datetime(2024, 1, 2, 3, 4, tzinfo=dt.timezone.utc).timestamp()) * 10**9
    assert got.key == f"WB-001-{ns}"
    assert json.loads(got.value) == {"product_id": "WB-001", "window_start": "2024-01-02T03:04:00.000000Z",
                                     "avg_rating": 4.25, "total_likes": 42, "review_count": 10, "is_update": False}


def test_timestamps_in_three_encodings(spark):
    ns = 1704164645000000000
    messages = [('{"id": "a", "date": "2024-01-02T03:04:05Z"}',), ('{"id": "b", "date": "2024-01-02T03:04:05"}',),
                (f'{{"id": "c", "date": {ns}}}',), ('{"id": "d", "date": "soon"}',)]
    got = codec.decode_json(spark.createDataFrame(messages, "value string"), REVIEW)
    assert {r.id: r.date for r in got.select("id", F.col("date").cast("string").alias("date")).collect()} == {
        "a": "2024-01-02 03:04:05", "b": "2024-01-02 03:04:05", "c": "2024-01-02 03:04:05", "d": None}


def test_bad_messages_are_kept_apart(spark):
    texts = [('{"id": "a"}',), ('{"id": "b", "ra',), ("",), ("[]x",), (None,)]
    decoded = codec.decode_json(spark.createDataFrame(texts, "value string"), REVIEW)
    good, bad = codec.split_corrupt(decoded)
    assert [r.id for r in good.collect()] == ["a"]
    assert sorted(r.value for r in bad.collect()) == ["", "", "[]x", '{"id": "b", "ra']


def test_unreadable_dates_are_kept_apart(spark):
    texts = [('{"id": "a", "date": "2024-01-02T03:04:05"}',), ('{"id": "b", "date": "soon"}',), ('{"id": "c"}',)]
    good, bad = codec.split_corrupt(codec.decode_json(spark.createDataFrame(texts, "value string"), REVIEW))
    assert sorted(r.id for r in good.collect()) == ["a", "c"]
    assert [r.value for r in bad.collect()] == [texts[1][0]]


def test_binary_values_decode(spark):
    df = spark.createDataFrame([(bytearray(b'{"id": "a"}'), 7)], "value binary, offset long")
    got = codec.decode_json(df, REVIEW).first()
    assert (got.id, got.offset) == ("a", 7)


def test_kafka_options():
    got = readers.kafka_options("broker:9092", readers.RAW_TOPIC, "earliest", readers.MAX_POLL_RECORDS)
    assert (got["startingOffsets"], got["maxOffsetsPerTrigger"], got["subscribe"]) == ("earliest", "500", "reviews.raw")


def test_tables_from_records(spark):
    arrow = pa.table({"review_count": pa.array([1]), "product_id": ["a"], "avg_rating": [4.0], "total_likes": [2],
                      "window_start": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("ns", "UTC"))})
    for records in (arrow, [{"product_id": "a", "window_start": at("2024-01-01"), "avg_rating": 4.0,
                             "total_likes": 2, "review_count": 1}], [("a", at("2024-01-01"), 4.0, 2, 1)]):
        df = readers.table_from_records(spark, records, WINDOW_SERVED)
        assert df.columns == WINDOW_SERVED.fieldNames()
        assert (df.first().product_id, df.first().review_count) == ("a", 1)
        assert df.select(F.col("window_start").cast("string")).first()[0] == "2024-01-01 00:00:00"


def test_table_scan_has_the_given_schema(spark, tmp_path):
    path = str(tmp_path / "r")
    review(spark).write.parquet(path)
    assert readers.read_table(spark, path, REVIEW).schema == REVIEW


def test_messages_are_counted_while_written(spark, tmp_path):
    df = spark.createDataFrame([("a", "{}"), ("b", "{}"), ("c", None)], readers.MESSAGE)
    seen = writers.write_messages(df, "json", {"path": str(tmp_path / "m")})
    assert seen.get == {"published": 2, "failed": 1}
    assert spark.read.schema(readers.MESSAGE).json(str(tmp_path / "m")).count() == 2


def test_order_inside_products_with_a_hot_one(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 7))
                                  .alias("product_id"),
                                  F.timestamp_seconds(F.lit(10**9) - F.col("id")).alias("date"))
    out = writers.ordered_by_product(df, 6).withColumn("part", F.spark_partition_id())
    rows = out.collect()
    keys = [(r.part, r.product_id, r.date) for r in rows]
    assert keys == sorted(keys)
    assert [k[1:] for k in keys] == sorted(k[1:] for k in keys)
    assert max(out.groupBy("part").count().toPandas()["count"]) < 1500


def test_metrics_csv_appends(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for total in (1, 2):
        writers.append_metrics_csv(spark.createDataFrame([(1.5, total)], "elapsed_s double, total_reviews long"), path)
    back = spark.read.option("header", True).schema("elapsed_s double, total_reviews long").csv(path)
    assert sorted(r.total_reviews for r in back.collect()) == [1, 2]


def test_sliding_messages_round_trip(spark):
    moment = at("2024-01-02 03:04:05")
    df = spark.createDataFrame([(moment, moment, moment, "a", 3, 4.5, 0.25, moment, 12.5)], SLIDING_AGG)
    back = codec.decode_json(codec.encode_sliding(df).select("value"), SLIDING_AGG).drop(codec.CORRUPT)
    assert back.collect() == df.collect()
