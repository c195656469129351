"""Records to and from JSON messages (key, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import parse_instant, to_epoch_ns

# ISO 8601 with zone; the same text in every writer, so readers can compare it.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
CORRUPT = "_corrupt_record"

RAW_FIELDS = ["id", "product_id", "rating", "text", "likes", "dislikes", "date"]
WINDOW_FIELDS = ["product_id", "window_start", "avg_rating", "total_likes", "review_count", "is_update"]
SLIDING_FIELDS = ["window_start", "window_end", "computed_at", "product_id", "review_count", "avg_rating",
                  "negative_share", "max_review_date", "latency_sec"]


def json_value(df: DataFrame, fields: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in fields if c in df.columns]),
                     {"timestampFormat": ISO_MICROS})


def encode_raw(reviews: DataFrame) -> DataFrame:
    """Messages keyed by product, so one product stays in one topic partition."""
    return reviews.select(F.col("product_id").alias("key"), json_value(reviews, RAW_FIELDS).alias("value"))


def encode_windowed(windows: DataFrame, *keep: str) -> DataFrame:
    """Messages identified by product and window start in nanoseconds; `keep` names columns to keep beside them."""
    key = F.concat_ws("-", "product_id", to_epoch_ns(F.col("window_start")).cast("string"))
    return windows.select(key.alias("key"), json_value(windows, WINDOW_FIELDS).alias("value"), *keep)


def encode_sliding(slides: DataFrame) -> DataFrame:
    return slides.select(F.col("product_id").alias("key"), json_value(slides, SLIDING_FIELDS).alias("value"))


def decode_json(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse every message; `_corrupt_record` holds the text of the unreadable ones.

    Unreadable: not valid JSON, a timestamp that is neither ISO text nor nanoseconds since 1970, or no content at all
    (an empty or missing value, for which the text is empty). Other columns are kept.
    """
    instants = {f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)}
    wire = T.StructType([T.StructField(f.name, T.StringType() if f.name in instants else f.dataType)
                         for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value).cast("string"), wire,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kept = [c for c in messages.columns if c != value and c not in schema.fieldNames()]

    def field(name: str) -> Column:
        raw = F.col(f"_json.{name}")
        return (parse_instant(raw) if name in instants else raw).alias(name)

    text = F.coalesce(F.col(value).cast("string"), F.lit(""))
    unreadable = F.col("_json").isNull()
    for name in instants:
        unreadable = unreadable | (F.col(f"_json.{name}").isNotNull() & parse_instant(F.col(f"_json.{name}")).isNull())
    corrupt = F.when(unreadable, text).otherwise(F.col(f"_json.{CORRUPT}")).alias(CORRUPT)
    return (messages.withColumn("_json", parsed)
            .select(*kept, *[field(f.name) for f in schema.fields], corrupt))


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable records, quarantined messages)"""
    good = decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = decoded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
    return good, bad
