"""Review tables derived from the given `events` and `documents` tables.

One review per event. Its text is the document at event_id modulo the number
of documents, so every document is used. Event types are too sparse for
one-minute windows, hence the wider sizes below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.windows import sliding, tumbling, tumbling_bucket
from opinara.sources.codec import RAW_FIELDS, json_value

HOUR, DAY = 3600, 86_400
WIDTH_S, LATENESS_S = 6 * HOUR, 12 * HOUR
SIZE_S, SLIDE_S = DAY, 6 * HOUR
RECENT_S, CHECK_S, COOLDOWN_S = 5 * DAY, 6 * HOUR, DAY

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def as_reviews(events: DataFrame) -> DataFrame:
    """Map events (batch or stream) to reviews without text."""
    # The events carry zone-free timestamps in UTC.
    events.sparkSession.conf.set("spark.sql.session.timeZone", "UTC")
    slot = F.col("user_id") % 20
    whole = F.floor("value").cast("int")
    date = F.col("ts").cast("timestamp")
    delay_min = ((F.col("event_id") * 7919) % 1440).cast("int")
    return events.select(
        F.concat(F.lit("src-"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.when(slot < 14, "WB-").otherwise("OZ-"),
                 F.lpad((slot + 1).cast("string"), 3, "0")).alias("product_id"),
        (whole % 7).alias("rating"), ((whole % 61) / 10.0).alias("rating_f"),
        (F.get_json_object("props", "$.k").cast("int") - 10).alias("likes"),
        (F.col("event_id") % 20).cast("int").alias("dislikes"),
        date.alias("date"), (date + F.make_dt_interval(mins=delay_min)).alias("arrival_ts"),
        F.col("event_id").alias("seq"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews without text: only the events are scanned."""
    return as_reviews(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def dated_ahead(reviews: DataFrame) -> DataFrame:
    """Every fiftieth review arrived an hour before its date."""
    early = F.col("date") - F.make_dt_interval(hours=F.lit(1))
    return reviews.withColumn("arrival_ts", F.when(F.col("seq") % 50 == 0, early).otherwise(F.col("arrival_ts")))


def reviews_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews where some dates and arrivals are missing."""
    return reviews(spark, sf_dir).withColumns({"date": F.when(F.col("seq") % 19 != 0, F.col("date")),
                                               "arrival_ts": F.when(F.col("seq") % 23 != 0, F.col("arrival_ts"))})


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("body"))


def with_document(reviews: DataFrame, documents: DataFrame, n_docs: int) -> DataFrame:
    return reviews.withColumn("doc_id", F.col("seq") % n_docs).join(documents, "doc_id").drop("doc_id")


def with_body(reviews: DataFrame) -> DataFrame:
    """Every thirteenth review has an empty text, the others that of their document."""
    return reviews.withColumn("text", F.when(F.col("seq") % 13 == 0, "").otherwise(F.col("body"))).drop("body")


def reviews_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir)
    return with_body(with_document(reviews(spark, sf_dir), documents, documents.count()))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling(reviews(spark, sf_dir), WIDTH_S)


def slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding(reviews(spark, sf_dir), SIZE_S, SLIDE_S)


def newest_window(spark: SparkSession, sf_dir: str) -> str:
    """Start of the newest window as text; a single value from one narrow scan."""
    newest = reviews(spark, sf_dir).agg(F.max("date").alias("date"))
    return newest.select(F.date_format(tumbling_bucket("date", WIDTH_S)["start"],
                                       "yyyy-MM-dd HH:mm:ss")).first()[0]


def reviews_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every review, and every tenth one a second time."""
    base = reviews(spark, sf_dir)
    return base.withColumn("copies", F.when(F.col("seq") % 10 == 0, F.array(F.lit(0), F.lit(1)))
                           .otherwise(F.array(F.lit(0)))).withColumn("_", F.explode("copies")).drop("copies", "_")


def reviews_refetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews whose ids are a product and a position, used again by every fetch."""
    return reviews(spark, sf_dir).withColumn("id", F.concat_ws("-", "product_id", (F.col("seq") % 3).cast("string")))


def message_value(base: DataFrame) -> Column:
    """Reviews as JSON; every fiftieth message is cut in half."""
    value = json_value(base, RAW_FIELDS)
    half = (F.char_length(value) / 2).cast("int")
    return F.when(F.col("seq") % 50 == 0, value.substr(F.lit(1), half)).otherwise(value)


def review_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = reviews_with_text(spark, sf_dir)
    return base.select("seq", F.col("product_id").alias("key"), message_value(base).alias("value"))


def reviews_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews where some ratings and products are missing."""
    return reviews(spark, sf_dir).withColumns({
        "rating": F.when(F.col("seq") % 11 != 0, F.col("rating")),
        "product_id": F.when(F.col("seq") % 17 != 0, F.col("product_id"))})


def windows_mixed_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose start is ISO with Z, ISO without zone, nanoseconds, or unreadable text."""
    start = F.col("window_start")
    kind = F.col("review_count") % 4
    return windows(spark, sf_dir).select(
        "product_id", "review_count",
        F.when(kind == 0, F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, (F.unix_micros(start) * 1000).cast("string"))
        .otherwise("garbage").alias("raw_start"))
