"""Cumulative review statistics, throughput and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import pct_change, ratio_or_zero
from opinara.operators.scaling import timeline_lag, timeline_totals

BUCKETS_PER_BLOCK = 4096


def valid_ratings(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("rating").between(1, 5))


def fill_defaults(reviews: DataFrame) -> DataFrame:
    """Absent rating counts as 0, absent product as "unknown"."""
    return reviews.withColumns({"rating": F.coalesce("rating", F.lit(0)),
                                "product_id": F.coalesce("product_id", F.lit("unknown"))})


def review_stats(reviews: DataFrame) -> DataFrame:
    ok = F.col("rating").between(1, 5)
    return (reviews.agg(F.count("*").alias("total"), F.count_if(ok).alias("valid"),
                        F.coalesce(F.sum(F.when(ok, F.col("rating"))), F.lit(0)).alias("s"))
            .select("total", "valid", (F.col("total") - F.col("valid")).alias("invalid"),
                    ratio_or_zero(F.col("s").cast("double"), F.col("valid")).alias("avg_rating")))


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Five rows, also for ratings nobody gave; share of the valid ratings in percent."""
    counts = reviews.agg(*[F.count_if(F.col("rating") == r).alias(f"n{r}") for r in range(1, 6)])
    valid = sum((F.col(f"n{r}") for r in range(2, 6)), F.col("n1"))
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rating"), F.col(f"n{r}").alias("n"))
                               for r in range(1, 6)]))
    return (counts.withColumn("valid", valid).select("valid", rows.alias("row"))
            .select("row.rating", "row.n", ratio_or_zero(F.col("row.n") * 100.0, F.col("valid")).alias("pct")))


def top_products(reviews: DataFrame, top: int = 5) -> DataFrame:
    """Products with most reviews, invalid ones included; ties go to the one seen first."""
    product = F.coalesce("product_id", F.lit("unknown")).alias("product_id")
    return (reviews.groupBy(product).agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
            .orderBy(F.desc("n"), "first_seq").limit(top).select("product_id", "n"))


def last_reviews(reviews: DataFrame, top: int = 5) -> DataFrame:
    return (reviews.orderBy(F.desc("seq")).limit(top)
            .select("seq", F.substring("id", 1, 20).alias("id"), "product_id", "rating"))


def throughput(reviews: DataFrame, interval_s: int = 5, ts: str = "arrival_ts") -> DataFrame:
    """One snapshot per interval from the first to the last review, empty intervals included.

    The dense grid comes from spark.range, so no task or row holds all of it.
    """
    spark = reviews.sparkSession
    slot = F.floor(F.unix_seconds(ts) / interval_s).alias("slot")
    counts = reviews.groupBy(slot).agg(F.count("*").alias("reviews"))
    low, high = reviews.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).select(
        F.floor(F.unix_seconds("a") / interval_s), F.floor(F.unix_seconds("b") / interval_s)).first()
    grid = spark.range(0 if low is None else low, 0 if high is None else high + 1).toDF("slot")
    dense = (grid.join(counts, "slot", "left")
             .select("slot", F.coalesce("reviews", F.lit(0)).cast("long").alias("reviews")))
    block = F.floor(F.col("slot") / BUCKETS_PER_BLOCK)
    return (timeline_totals(dense, "slot", "reviews", block)
            .select(F.timestamp_seconds((F.col("slot") + 1) * interval_s).alias("snapshot_at"),
                    ((F.col("slot") - F.lit(low) + 1) * interval_s).cast("double").alias("elapsed_s"),
                    F.col("running_reviews").alias("total_reviews"),
                    (F.col("reviews") / float(interval_s)).alias("reviews_per_sec")))


def throughput_delta(snapshots: DataFrame, block_s: int = 86_400) -> DataFrame:
    """Rate between consecutive snapshots: growth of the total over the time between them."""
    block = F.floor(F.unix_seconds("snapshot_at") / block_s)
    lagged = timeline_lag(snapshots, "snapshot_at", ["snapshot_at", "total_reviews"], block)
    dt = (F.unix_micros("snapshot_at") - F.unix_micros("prev_snapshot_at")) / 1e6
    grown = F.col("total_reviews") - F.coalesce(F.col("prev_total_reviews"), F.lit(0))
    return lagged.select("snapshot_at", "total_reviews", grown.alias("new_reviews"),
                         F.when(dt > 0, grown / dt).otherwise(0.0).alias("reviews_per_sec"))


def moving_rate(reviews: DataFrame, span_s: int = 5, step_s: int = 1, ts: str = "arrival_ts") -> DataFrame:
    """Rate over the trailing `span_s` seconds, sampled once per step that saw a review.

    Growth since the oldest sample still inside the span, over the time since
    then; 0 with a single sample. Per-step counts are copied forward into the
    few samples they matter to, so no window spans the timeline. The span must be a multiple of the step.
    """
    if span_s % step_s:
        raise ValueError(f"span of {span_s} s is not a multiple of the step of {step_s} s")
    steps = span_s // step_s
    counts = (reviews.groupBy(F.floor(F.unix_seconds(ts) / step_s).alias("src"))
              .agg(F.count("*").alias("n")))
    spread = counts.select("src", "n", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("ahead"))
    return (spread.groupBy((F.col("src") + F.col("ahead")).alias("slot"))
            .agg(F.count_if(F.col("ahead") == 0).alias("sampled"), F.sum("n").alias("n"),
                 F.min_by("n", "src").alias("oldest"), F.min("src").alias("from_slot"))
            .filter("sampled > 0")
            .select(F.timestamp_seconds(F.col("slot") * step_s).alias("sampled_at"),
                    (F.col("n") - F.col("oldest")).alias("new_reviews"),
                    ratio_or_zero((F.col("n") - F.col("oldest")).cast("double"),
                                  (F.col("slot") - F.col("from_slot")) * step_s).alias("reviews_per_sec")))


def run_summary(snapshots: DataFrame) -> DataFrame:
    """Duration and total at the last snapshot, mean and peak of the rate."""
    return snapshots.agg(
        F.max_by("elapsed_s", "snapshot_at").alias("duration_s"),
        F.max_by("total_reviews", "snapshot_at").alias("total_reviews"),
        F.avg("reviews_per_sec").alias("avg_rps"), F.max("reviews_per_sec").alias("peak_rps"))


def run_totals(reviews: DataFrame) -> DataFrame:
    """Reviews per product and, with product_id "TOTAL", overall."""
    per_product = reviews.groupBy("product_id").agg(F.count("*").alias("n"))
    return (per_product.rollup("product_id").agg(F.sum("n").alias("n"), F.grouping("product_id").alias("all"))
            .select(F.when(F.col("all") == 1, "TOTAL").otherwise(F.col("product_id")).alias("product_id"), "n"))


def as_metrics(summary: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per (metric, value) from a one-row summary."""
    return (summary.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
        .alias("m")).select("m.metric", "m.value"))


def compare_runs(base: DataFrame, other: DataFrame) -> DataFrame:
    """Metric by metric change of `other` against `base`; null where it cannot be computed."""
    return (base.withColumnRenamed("value", "base_value")
            .join(other.withColumnRenamed("value", "other_value"), "metric", "full_outer")
            .select("metric", "base_value", "other_value",
                    pct_change(F.col("base_value"), F.col("other_value")).alias("change_pct"),
                    F.try_divide(F.greatest("base_value", "other_value"),
                                 F.least("base_value", "other_value")).alias("ratio")))


def parse_summaries(lines: DataFrame, schema, line: str = "line") -> DataFrame:
    """Run summary embedded in log text after `SUMMARY_JSON:`; error where there is none to read."""
    body = F.regexp_extract(line, r"(?s)SUMMARY_JSON:\s*(\{.*\})", 1)
    parsed = F.from_json(body, schema, {"mode": "PERMISSIVE"})
    found = lines.withColumn("_s", F.when(F.length(body) > 0, parsed))
    fields = schema.fieldNames()
    return found.select(*[c for c in lines.columns if c != line],
                        *[F.col(f"_s.{f}").alias(f) for f in fields],
                        F.when(F.coalesce(*[F.col(f"_s.{f}").cast("string") for f in fields]).isNull(),
                               "no summary").alias("error"))


def product_backlog(products: DataFrame, taken: DataFrame) -> DataFrame:
    """Listed products nobody has taken yet. The taken side shrinks to its distinct ids before the join."""
    return products.join(taken.select("product_id").distinct(), "product_id", "left_anti")

