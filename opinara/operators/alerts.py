"""Rating alerts over recent windows, their history, and the cooldown between them."""

from __future__ import annotations

from datetime import datetime
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import exact_mean, fixed_text
from opinara.operators.scaling import hopping_sums
from opinara.operators.tables import retain_since
from opinara.session import durable

# Fixed values of the alert contract.
RATING_THRESHOLD = 3.0
NEGATIVE_BELOW = 3.0
NEGATIVE_SHARE_THRESHOLD = 0.30
RECENT_S = 600
CHECK_EVERY_S = 60
COOLDOWN_S = 300


def _named(windows: DataFrame) -> DataFrame:
    """Windows of a known product; a missing rating counts as 0 and so as negative."""
    return (windows.filter(F.coalesce(F.col("product_id"), F.lit("")) != "")
            .withColumn("avg_rating", F.coalesce("avg_rating", F.lit(0.0))))



def anomaly_scores(windows: DataFrame, as_of: datetime | str, recent_s: int = RECENT_S) -> DataFrame:
    """Per product over the recent windows: mean rating and number of negative windows."""
    return (_named(retain_since(windows, as_of, recent_s)).groupBy("product_id")
            .agg(exact_mean(F.col("avg_rating"), 2).alias("mean_rating"),
                 F.count_if(F.col("avg_rating") < NEGATIVE_BELOW).alias("negative"),
                 F.count("*").alias("windows")))


def anomaly_messages(scores: DataFrame, rating_threshold: float = RATING_THRESHOLD,
                     share_threshold: float = NEGATIVE_SHARE_THRESHOLD) -> DataFrame:
    """One row per broken rule. The rules are independent, a product can break both."""
    share = F.col("negative") / F.col("windows")
    low = F.when(F.col("mean_rating") < rating_threshold, F.struct(
        F.lit("low_rating").alias("rule"),
        F.concat(F.lit("Mean rating of "), F.col("product_id"), F.lit(" fell to "),
                 fixed_text(F.col("mean_rating"), 2), F.lit(f" (threshold {rating_threshold:.1f})"))
        .alias("message")))
    negative = F.when(share > share_threshold, F.struct(
        F.lit("negative_share").alias("rule"),
        F.concat(F.lit("Negative share of "), F.col("product_id"), F.lit(" is "),
                 fixed_text(share * 100.0, 0),
                 F.lit(f"% (threshold {share_threshold * 100:.0f}%, "), F.col("negative").cast("string"),
                 F.lit("/"), F.col("windows").cast("string"), F.lit(" windows)")).alias("message")))
    hits = F.explode(F.filter(F.array(low, negative), lambda hit: hit.isNotNull()))
    others = [c for c in scores.columns if c != "product_id"]
    return (scores.select("product_id", *others, hits.alias("hit"))
            .select("product_id", *others, "hit.rule", "hit.message"))


def anomalies(windows: DataFrame, as_of: datetime | str, recent_s: int = RECENT_S,
              rating_threshold: float = RATING_THRESHOLD,
              share_threshold: float = NEGATIVE_SHARE_THRESHOLD) -> DataFrame:
    return anomaly_messages(anomaly_scores(windows, as_of, recent_s), rating_threshold, share_threshold)


def check_sums(windows: DataFrame, bucket: Column) -> DataFrame:
    """Per product and bucket w of window starts: rating sum in hundredths, number of windows, number of negative ones."""
    hundredths = F.rint(F.col("avg_rating") * 100.0).cast("long")
    return (_named(windows).groupBy("product_id", bucket.alias("w"))
            .agg(F.sum(hundredths).alias("h"), F.count("*").alias("c"),
                 F.count_if(F.col("avg_rating") < NEGATIVE_BELOW).alias("neg")))


def check_scores() -> list[Column]:
    """The scores of a check from the sums of its windows."""
    return [(F.col("h").cast("double") / F.col("c") / 100.0).alias("mean_rating"), F.col("neg").alias("negative"),
            F.col("c").alias("windows")]


def anomaly_history(windows: DataFrame, recent_s: int = RECENT_S, every_s: int = CHECK_EVERY_S,
                    rating_threshold: float = RATING_THRESHOLD,
                    share_threshold: float = NEGATIVE_SHARE_THRESHOLD) -> DataFrame:
    """What a check every `every_s` seconds would have raised, over all of history.

    A check at t looks at windows starting in [t - recent, t). Windows are
    reduced to panes first, and checks come from running totals over these.
    """
    if every_s > recent_s:
        raise ValueError("checks further apart than the recent stretch would skip windows")
    pane_s = gcd(recent_s, every_s)
    panes = (check_sums(windows, F.window("window_start", f"{pane_s} seconds"))
             .select("product_id", F.col("w.start").alias("pane"), "h", "c", "neg"))
    scores = (hopping_sums(panes, "product_id", "pane", recent_s, every_s, ["h", "c", "neg"])
              .select("product_id", (F.col("hop_start") + F.make_dt_interval(secs=F.lit(recent_s)))
                      .alias("check_at"), *check_scores()))
    return anomaly_messages(scores, rating_threshold, share_threshold)


def alert_cooldown(history: DataFrame, every_s: int = CHECK_EVERY_S, cooldown_s: int = COOLDOWN_S,
                   block_steps: int = 1440, fanout: int = 64) -> DataFrame:
    """Alerts that go out when a product stays silent for `cooldown_s` after each one sent.

    Which alerts are sent depends on the one sent before, but only through how
    many checks are still to be skipped. So each block of `block_steps` checks
    is summarized as "skips left before -> skips left after" for every possible
    value. Such maps compose, so `fanout` blocks are summarized to one of the
    next level and so on; going down again, each block learns what it begins
    with and is replayed on its own. No list is longer than `block_steps` or
    `fanout`, however long the history is.
    """
    skip = -(-cooldown_s // every_s)
    block_steps = max(block_steps, skip)
    step = F.floor(F.unix_seconds("check_at") / every_s)
    checks = durable(history.select("product_id", step.alias("step")).distinct()
                     .groupBy("product_id", F.floor(F.col("step") / block_steps).alias("block"))
                     .agg(F.array_sort(F.collect_set(F.pmod("step", F.lit(block_steps)).cast("int"))).alias("steps")))

    def free_after(start: Column) -> Column:
        """First step free again after the block, given the first free step in it."""
        return F.aggregate("steps", start.cast("int"),
                           lambda free, s: F.when(s >= free, s + skip).otherwise(free))

    starts = F.sequence(F.lit(0), F.lit(max(skip - 1, 0)))
    outcome = F.transform(starts, lambda start: F.greatest(free_after(start) - block_steps, F.lit(0)))
    first, last = checks.agg(F.min("block"), F.max("block")).first()
    entries = _entries(checks.select("product_id", "block", outcome.alias("outcome")), starts, fanout,
                       first or 0, last or 0)
    replay_start = F.struct(F.col("free").alias("free"), F.array().cast("array<int>").alias("sent"))

    def replay(state: Column, s: Column) -> Column:
        due = s >= state["free"]
        return F.struct(F.when(due, s + skip).otherwise(state["free"]).alias("free"),
                        F.when(due, F.concat(state["sent"], F.array(s))).otherwise(state["sent"]).alias("sent"))

    sent = (checks.join(entries, ["product_id", "block"])
            .select("product_id", "block",
                    F.explode(F.aggregate("steps", replay_start, replay)["sent"]).alias("s"))
            .select("product_id", (F.col("block") * block_steps + F.col("s")).alias("_step")))
    return (history.withColumn("_step", step).join(sent, ["product_id", "_step"], "left_semi")
            .select(*history.columns))


def _entries(blocks: DataFrame, starts: Column, fanout: int, first: int, last: int) -> DataFrame:
    """The skips left at the beginning of every block (`free`), from each block's `outcome` per number of skips left.

    first, last: of all block numbers. A block that is missing has no alert, and a block is at
    least as long as the cooldown, so nothing is left to skip after it.
    """
    many = last - first >= fanout
    up = (F.floor(F.col("block") / fanout) if many else F.lit(0)).cast("long").alias("up")
    groups = (blocks.groupBy("product_id", up)
              .agg(F.array_sort(F.collect_list(F.struct("block", "outcome"))).alias("blocks")))

    def entry(state: Column, b: Column) -> Column:
        return F.when(b["block"] == state["next"], state["free"]).otherwise(F.lit(0))

    def after(state: Column, b: Column) -> Column:
        return F.struct((b["block"] + 1).alias("next"), F.element_at(b["outcome"], entry(state, b) + 1).alias("free"))

    def listed(state: Column, b: Column) -> Column:
        reached = after(state, b)
        return F.struct(reached["next"].alias("next"), reached["free"].alias("free"), F.concat(state["entry"], F.array(
            F.struct(b["block"].alias("block"), entry(state, b).alias("free")))).alias("entry"))

    begin = F.col("up") * fanout
    if many:
        def outcome(start: Column) -> Column:
            end = F.aggregate("blocks", F.struct(begin.alias("next"), start.cast("int").alias("free")), after)
            return F.when(end["next"] == begin + fanout, end["free"]).otherwise(F.lit(0))
        above = _entries(groups.select("product_id", F.col("up").alias("block"), F.transform(starts, outcome).alias("outcome")),
                         starts, fanout, first // fanout, last // fanout)
        groups = groups.join(above.withColumnRenamed("block", "up"), ["product_id", "up"])
    else:
        begin, groups = F.lit(None).cast("long"), groups.withColumn("free", F.lit(0))
    none = F.struct(begin.alias("next"), F.col("free").alias("free"),
                    F.array().cast("array<struct<block:bigint,free:int>>").alias("entry"))
    return (groups.select("product_id", F.explode(F.aggregate("blocks", none, listed)["entry"]).alias("e"))
            .select("product_id", "e.block", "e.free"))
