"""Event-time windows: tumbling with late corrections, and sliding by arrival."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import half_even, half_up
from opinara.operators.scaling import MAX_GROUP_ROWS, attach_small, hopping_sums, running_totals

# Seconds from 0001-01-01 to 1970-01-01: window boundaries count from year 1.
YEAR_ONE_TO_EPOCH = 62_135_596_800


def tumbling_bucket(ts: Column | str, width_s: int) -> Column:
    """window struct; boundaries are multiples of the width counted from year 1."""
    if width_s <= 0:
        raise ValueError("window width must be positive")
    offset = -YEAR_ONE_TO_EPOCH % width_s
    return F.window(ts, f"{width_s} seconds", f"{width_s} seconds", f"{offset} seconds")


def total(column: str) -> Column:
    """Sum in which an absent value counts as 0."""
    return F.sum(F.coalesce(F.col(column), F.lit(0)))


def finish_tumbling(rating_sum: Column, likes: Column, reviews: Column) -> list[Column]:
    return [half_up(rating_sum / reviews, 2).alias("avg_rating"),
            likes.alias("total_likes"), reviews.alias("review_count")]


def tumbling(reviews: DataFrame, width_s: int = 60) -> DataFrame:
    """Per product and window: mean rating, likes, count. Ratings are not checked here."""
    return (reviews.groupBy("product_id", tumbling_bucket("date", width_s).alias("w"))
            .agg(total("rating").alias("r"), total("likes").alias("l"), F.count("*").alias("c"))
            .select("product_id", F.col("w.start").alias("window_start"),
                    *finish_tumbling(F.col("r"), F.col("l"), F.col("c"))))


def classify_arrival(reviews: DataFrame, width_s: int, lateness_s: int) -> DataFrame:
    """Add window_start and arrival_class: on_time, late (window closed, still corrected) or dropped.

    Stateless and exact, so it is also the too-old rule of the stream.
    """
    start = F.col("window_start")
    age_us = F.unix_micros("arrival_ts") - F.unix_micros(start)
    width_us, total_us = width_s * 1_000_000, (width_s + lateness_s) * 1_000_000
    return (reviews.withColumn("window_start", tumbling_bucket("date", width_s)["start"])
            .withColumn("arrival_class", F.when(age_us <= width_us, "on_time")
                        .when(age_us <= total_us, "late").otherwise("dropped")))


def reviews_by_fate(reviews: DataFrame, width_s: int, lateness_s: int) -> DataFrame:
    """How many reviews a window job accepts (on_time, late), drops as too old (dropped) or cannot place (no_date,
    no_arrival): fate, n. The counts add up to the input."""
    dated = reviews.filter("date is not null and arrival_ts is not null")
    fates = classify_arrival(dated, width_s, lateness_s).select(F.col("arrival_class").alias("fate"))
    return fates.unionByName(unplaced(reviews).select(F.col("reason").alias("fate"))).groupBy("fate").agg(F.count("*").alias("n"))


def unplaced(reviews: DataFrame) -> DataFrame:
    """Reviews that belong to no window, with the reason."""
    reason = F.when(F.col("date").isNull(), "no_date").when(F.col("arrival_ts").isNull(), "no_arrival")
    return reviews.withColumn("reason", reason).filter("reason is not null")


def tumbling_changelog(reviews: DataFrame, width_s: int, lateness_s: int,
                       max_group_rows: int = MAX_GROUP_ROWS, chunks: int | None = None) -> DataFrame:
    """Everything a window ever emits: its totals at closing, then one row per late review.

    is_update is false for the emission that first publishes a window (of any
    product) and true for every later correction. A window without an on-time
    review is first published by its earliest late one.
    """
    kept = (classify_arrival(reviews, width_s, lateness_s)
            .filter("arrival_class <> 'dropped'")
            .select("product_id", "window_start", "arrival_class", "arrival_ts", "seq",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c[0]) for c in ("rating", "likes")]))
    closing = (kept.filter("arrival_class = 'on_time'").groupBy("product_id", "window_start")
               .agg(F.sum("r").alias("r"), F.sum("l").alias("l"), F.count("*").alias("c"),
                    F.max("seq").alias("seq"))
               .withColumns({"emitted_at": F.col("window_start") + F.make_dt_interval(secs=F.lit(width_s)),
                             "at_close": F.lit(True)}))
    late = (kept.filter("arrival_class = 'late'")
            .select("product_id", "window_start", F.col("arrival_ts").alias("emitted_at"), "seq",
                    "r", "l", F.lit(1).cast("long").alias("c"), F.lit(False).alias("at_close")))
    # One row per window that nobody published at closing: the review that opens it.
    openers = (kept.groupBy("window_start")
               .agg(F.count_if(F.col("arrival_class") == "on_time").alias("on_time"),
                    F.min(F.struct("arrival_ts", "seq")).alias("first"))
               .filter("on_time = 0")
               .select("window_start", F.col("first.arrival_ts").alias("emitted_at"),
                       F.col("first.seq").alias("seq"), F.lit(True).alias("opens")))
    group = ["product_id", "window_start"]
    sizes = (kept.filter("arrival_class = 'late'").groupBy(*group)
             .agg((F.count("*") + 1).alias("_n")))  # its late reviews and one closing row
    emissions = running_totals(closing.unionByName(late), group, ["emitted_at", "seq"], ["r", "l", "c"],
                               max_group_rows, chunks, sizes)
    flagged = attach_small(emissions, openers, ["window_start", "emitted_at", "seq"])
    return flagged.select(
        "product_id", "window_start", "emitted_at", "seq",
        *finish_tumbling(F.col("running_r"), F.col("running_l"), F.col("running_c")),
        (~F.col("at_close") & F.col("opens").isNull()).alias("is_update"))


def sliding(reviews: DataFrame, size_s: int = 300, slide_s: int = 60,
            ts: str = "arrival_ts") -> DataFrame:
    """Overlapping windows by arrival, valid ratings only.

    A review without product counts for "unknown", one without date as fresh.
    Reviews are first reduced to panes of gcd(size, slide); windows come from
    running totals over them, so nothing is copied once per window.
    """
    check_sliding(size_s, slide_s)
    pane_s = gcd(size_s, slide_s)
    return slide_panes(sliding_panes(reviews, pane_s, ts), size_s, slide_s)


def sliding_panes(reviews: DataFrame, pane_s: int, ts: str = "arrival_ts") -> DataFrame:
    """Sums of valid ratings per product and pane of arrival time."""
    return (sliding_input(reviews, ts).groupBy("product_id", F.window(ts, f"{pane_s} seconds").alias("w"))
            .agg(*sliding_sums())
            .select("product_id", F.col("w.start").alias("pane"), "c", "r", "neg", "newest"))


def slide_panes(panes: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    """Windows from panes; a pane may come in several rows."""
    merged = (hopping_sums(panes, "product_id", "pane", size_s, slide_s, ["c", "r", "neg"], ["newest"])
              .withColumn("hop_end", F.col("hop_start") + F.make_dt_interval(secs=F.lit(size_s))))
    return finish_sliding(merged, "hop_start", "hop_end")


def sliding_input(reviews: DataFrame, ts: str = "arrival_ts") -> DataFrame:
    return (reviews.filter(F.col("rating").between(1, 5))
            .withColumns({"product_id": F.coalesce("product_id", F.lit("unknown")),
                          "date": F.coalesce("date", ts)}))


def sliding_sums() -> list[Column]:
    return [F.count("*").alias("c"), F.sum("rating").alias("r"),
            F.count_if(F.col("rating") < 3).alias("neg"), F.max("date").alias("newest")]


def check_sliding(size_s: int, slide_s: int) -> None:
    if size_s <= 0 or slide_s <= 0:
        raise ValueError("window size and slide must be positive")
    if slide_s > size_s:
        raise ValueError("slide must not exceed the window size: reviews in the gap would be lost")


def finish_sliding(sums: DataFrame, start: str, end: str) -> DataFrame:
    lag_s = (F.unix_micros(end) - F.unix_micros("newest")) / 1e6
    return sums.select(
        F.col(start).alias("window_start"), F.col(end).alias("window_end"),
        F.col(end).alias("computed_at"), "product_id", F.col("c").alias("review_count"),
        half_even(F.col("r") / F.col("c"), 2).alias("avg_rating"),
        half_even(F.col("neg") / F.col("c"), 4).alias("negative_share"),
        F.col("newest").alias("max_review_date"),
        half_even(F.greatest(F.lit(0.0), lag_s), 2).alias("latency_sec"))
