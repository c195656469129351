"""Dashboard questions over the two aggregate tables.

`windows` are tumbling results (product_id, window_start, avg_rating, ...),
`slides` are sliding results (product_id, computed_at, ...). Means over
avg_rating are not weighted by review_count; the weighted form has its own name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import exact_mean, fixed_text, percent_text, rating_band
from opinara.operators.scaling import timeline_totals


def kpi_windows(windows: DataFrame, approximate: bool = False) -> DataFrame:
    products = F.approx_count_distinct("product_id") if approximate else F.count_distinct("product_id")
    return windows.agg(
        F.count("*").alias("windows"), products.alias("products"),
        exact_mean(F.col("avg_rating"), 2).alias("avg_rating"),
        F.coalesce(F.sum("total_likes"), F.lit(0)).alias("total_likes"))


def weighted_rating(windows: DataFrame) -> DataFrame:
    """Mean rating per product weighted by the number of reviews in each window."""
    units = F.sum(F.rint(F.col("avg_rating") * 100.0).cast("long") * F.col("review_count"))
    return (windows.groupBy("product_id")
            .agg((units.cast("double") / F.sum("review_count") / 100.0).alias("weighted_rating")))


def latest_per_product(slides: DataFrame, at: str = "computed_at", key: str = "product_id") -> DataFrame:
    """Last non-null value of each column per product, as aggregates rather than a sorted window."""
    def newest(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(c)

    return slides.groupBy(key).agg(*[newest(c) for c in slides.columns if c != key])


def kpi_latest(slides: DataFrame) -> DataFrame:
    """KPIs over the latest row of each product, plus the latency of the last row to arrive."""
    arrived_last = F.struct("computed_at", "product_id")
    # Latest rows per product contain the overall last row, so one pass is enough.
    return latest_per_product(slides).agg(
        exact_mean(F.col("avg_rating"), 2).alias("avg_rating"),
        F.coalesce(F.sum("review_count"), F.lit(0)).alias("review_count"),
        (exact_mean(F.col("negative_share"), 4) * 100.0).alias("negative_pct"),
        F.max_by("latency_sec", arrived_last).alias("last_latency_sec"))


def top_latest(slides: DataFrame, top: int = 20) -> DataFrame:
    return (latest_per_product(slides).orderBy(F.desc("review_count"), "product_id").limit(top)
            .select("product_id", "review_count", "avg_rating"))


def reviews_by_product(windows: DataFrame) -> DataFrame:
    return (windows.groupBy("product_id").agg(F.sum("review_count").alias("review_count"))
            .orderBy(F.desc("review_count"), "product_id"))


def top_rated(windows: DataFrame, top: int = 20) -> DataFrame:
    return (windows.groupBy("product_id").agg(exact_mean(F.col("avg_rating"), 2).alias("avg_rating"))
            .orderBy(F.desc("avg_rating"), "product_id").limit(top))


def timeline(windows: DataFrame) -> DataFrame:
    return (windows.groupBy("window_start").agg(F.sum("review_count").alias("review_count"))
            .orderBy("window_start"))


def latency_series(slides: DataFrame, last_s: int = 1800) -> DataFrame:
    """Mean latency per computed_at over the last stretch, measured back from the newest one.

    The cut-off is a scalar subquery: rows older than it are dropped by a plain
    filter before the aggregate.
    """
    newest = slides.agg(F.max("computed_at")).scalar()
    return (slides.filter(F.col("computed_at") >= newest - F.make_dt_interval(secs=F.lit(last_s)))
            .groupBy("computed_at").agg(exact_mean(F.col("latency_sec"), 2).alias("latency_sec"))
            .orderBy("computed_at"))


def current_latency(slides: DataFrame, last_s: int = 1800) -> DataFrame:
    return latency_series(slides, last_s).agg(F.max("computed_at").alias("computed_at"),
                                              F.max_by("latency_sec", "computed_at").alias("latency_sec"))


def product_list(df: DataFrame) -> DataFrame:
    return df.select("product_id").distinct().orderBy("product_id")


def product_series(slides: DataFrame, product_id: str | None = None) -> DataFrame:
    """Rating and negative share in percent over time, for one product or all."""
    chosen = slides if product_id is None else slides.filter(F.col("product_id") == product_id)
    return (chosen.select("product_id", "computed_at", "avg_rating",
                          (F.col("negative_share") * 100.0).alias("negative_pct"))
            .orderBy("product_id", "computed_at"))


def rating_bands(windows: DataFrame) -> DataFrame:
    return windows.select("product_id", "window_start", "avg_rating",
                          rating_band(F.col("avg_rating")).alias("band"))


def recent_table(slides: DataFrame, top: int = 50) -> DataFrame:
    """The newest aggregates, formatted for display."""
    return (slides.orderBy(F.desc("computed_at"), "product_id").limit(top)
            .select("product_id", "review_count",
                    fixed_text(F.col("avg_rating"), 2).alias("avg_rating"),
                    percent_text(F.col("negative_share"), 1).alias("negative_share"),
                    F.concat(fixed_text(F.col("latency_sec"), 1), F.lit("s")).alias("latency"),
                    F.date_format("computed_at", "HH:mm:ss").alias("time")))


def windows_newest(windows: DataFrame) -> DataFrame:
    """Display table of windows, latest first."""
    return (windows.orderBy(F.desc("window_start"), F.desc("product_id"))
            .select("product_id", "avg_rating", "total_likes", "review_count",
                    F.date_format("window_start", "HH:mm:ss").alias("window_time")))


def emissions_newest(emissions: DataFrame, order: tuple[str, str] = ("emitted_at", "seq"), block_s: int = 3600) -> DataFrame:
    """Display table of emitted windows in the order of their arrival, latest first; position counts from the first.

    Emissions are numbered per block of time plus the counts of the blocks before, so no task gets all of them.
    """
    placed = emissions.withColumns({"_at": F.struct(*order), "emission": F.lit(1).cast("long")})
    numbered = timeline_totals(placed, "_at", "emission", F.floor(F.unix_seconds(order[0]) / block_s))
    return (numbered.orderBy(F.desc("running_emission"))
            .select(F.col("running_emission").alias("position"), "product_id", "avg_rating", "total_likes", "review_count",
                    F.date_format("window_start", "HH:mm:ss").alias("window_time")))


def windows_sorted(windows: DataFrame, head: int | None = None) -> DataFrame:
    ordered = windows.orderBy("window_start", "product_id")
    return ordered if head is None else ordered.limit(head)
