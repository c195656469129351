"""Record types used across the library. Schemas are always explicit, never inferred."""

from pyspark.sql import types as T

REVIEW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("likes", T.IntegerType()),
    T.StructField("dislikes", T.IntegerType()),
    T.StructField("date", T.TimestampType()),
])

# A review as it reaches validation: rating may be fractional.
CANDIDATE_REVIEW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("likes", T.IntegerType()),
])

WINDOW_AGG = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("total_likes", T.LongType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("is_update", T.BooleanType()),
])

# What readers of the window table get: five columns, none of them null.
WINDOW_SERVED = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("avg_rating", T.DoubleType(), False),
    T.StructField("total_likes", T.LongType(), False),
    T.StructField("review_count", T.LongType(), False),
])

SLIDING_AGG = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("computed_at", T.TimestampType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("negative_share", T.DoubleType()),
    T.StructField("max_review_date", T.TimestampType()),
    T.StructField("latency_sec", T.DoubleType()),
])

RUN_SUMMARY = T.StructType([
    T.StructField("language", T.StringType()),
    T.StructField("wall_clock_s", T.DoubleType()),
    T.StructField("total_reviews", T.LongType()),
    T.StructField("rps", T.DoubleType()),
    T.StructField("peak_rps", T.DoubleType()),
])
