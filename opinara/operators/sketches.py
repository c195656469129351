"""Approximate counts that can be stored per interval and merged over any span, with their error in the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.windows import tumbling_bucket

#: Registers of a distinct count: 2 ** LG_K bytes at most, whatever is counted.
LG_K = 12
#: Entries of a frequent-item sketch. Up to three quarters as many products are counted exactly.
TRACKED = 1024
#: An estimate of distinct values lies within so many standard errors of 1.04 / sqrt(registers).
ERRORS = 4.0


def interval_sketches(reviews: DataFrame, width_s: int, ts: str = "date", lg_k: int = LG_K, tracked: int = TRACKED) -> DataFrame:
    """One row per interval: start, number of reviews, sketches of ids, of products and of the reviews per product.

    A task sends one row per interval. A review without product counts for "unknown", one without date is left out.
    """
    product = "coalesce(product_id, 'unknown')"
    return (reviews.filter(F.col(ts).isNotNull()).groupBy(tumbling_bucket(ts, width_s)["start"].alias("start"))
            .agg(F.count("*").alias("reviews"), F.hll_sketch_agg("id", lg_k).alias("ids"),
                 F.hll_sketch_agg(F.expr(product), lg_k).alias("products"),
                 F.expr(f"approx_top_k_accumulate({product}, {tracked})").alias("top")))


def merged(sketches: DataFrame, *by: Column, tracked: int = TRACKED) -> DataFrame:
    """Sketches of any set of intervals in one; by a column, one per value."""
    return sketches.groupBy(*by).agg(F.sum("reviews").alias("reviews"), F.hll_union_agg("ids").alias("ids"),
                                     F.hll_union_agg("products").alias("products"),
                                     F.expr(f"approx_top_k_combine(top, {tracked})").alias("top"))


def rolling(sketches: DataFrame, width_s: int, intervals: int, tracked: int = TRACKED) -> DataFrame:
    """Sketches of every span of so many intervals that holds a review: span_start and the columns of `merged`.

    Only sketches are copied into the spans, never reviews.
    """
    back = F.explode(F.sequence(F.lit(0), F.lit(intervals - 1)))
    placed = sketches.withColumn("_back", back).withColumn(
        "span_start", F.col("start") - F.make_dt_interval(secs=F.col("_back") * width_s))
    return merged(placed, F.col("span_start"), tracked=tracked)


def distinct_counts(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Estimates of distinct ids and products, each with its bounds; other columns but the sketches are kept."""
    error = ERRORS * 1.04 / 2 ** (lg_k / 2)
    kept = [c for c in sketches.columns if c not in ("ids", "products", "top")]
    out = []
    for name in ("ids", "products"):
        estimate = F.hll_sketch_estimate(name)
        out += [estimate.alias(name), F.floor(estimate * (1 - error)).alias(f"{name}_low"), F.ceil(estimate * (1 + error)).alias(f"{name}_high")]
    return sketches.select(*kept, *out)


def top_counts(sketches: DataFrame, by: str, k: int = 5, tracked: int = TRACKED) -> DataFrame:
    """The k most frequent products per value of `by`: rank, product_id, n and max_error (n may be off by so many)."""
    exact = F.col("n_items") <= int(0.75 * tracked)
    items = (sketches.withColumn("_items", F.expr(f"approx_top_k_estimate(top, {tracked})"))
             .withColumn("n_items", F.size("_items"))
             .select(by, "reviews", "n_items", F.explode("_items").alias("i"))
             .select(by, F.col("i.item").alias("product_id"), F.col("i.count").alias("n"),
                     F.when(exact, 0).otherwise(F.ceil(F.col("reviews") * 3.5 / tracked)).cast("long").alias("max_error")))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "product_id"))
    return items.withColumn("rank", rank).filter(F.col("rank") <= k).select(by, "rank", "product_id", "n", "max_error")
