"""Helpers that keep hot keys and long timelines from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import durable

# A group up to this many rows is scanned by a single task.
MAX_GROUP_ROWS = 5_000_000
# Above this many rows a lookup side is shuffled instead of broadcast.
MAX_BROADCAST_ROWS = 200_000


def attach_small(df: DataFrame, lookup: DataFrame, on: Sequence[str],
                 max_rows: int = MAX_BROADCAST_ROWS, salts: int = 16) -> DataFrame:
    """Left join with a lookup that is usually small: its rows are counted first.

    The lookup is materialized, so counting it does not compute it twice.
    Past `max_rows` the join is shuffled, with the rows of one key spread over
    `salts` tasks and the lookup repeated for each of them.
    """
    on = list(on)
    lookup = durable(lookup)
    if lookup.count() <= max_rows:
        return df.join(F.broadcast(lookup), on, "left")
    spread = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    repeated = lookup.withColumn("_salt", F.explode(F.array(*[F.lit(s).cast("long") for s in range(salts)])))
    return spread.join(repeated, [*on, "_salt"], "left").drop("_salt")


def few_or_shuffled(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A stored table for the right side of a join: broadcast if it has few rows."""
    return F.broadcast(lookup) if lookup.count() <= max_rows else lookup


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   columns: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS,
                   chunks: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Add `running_<c>`: the sum of `c` over its group, in `order`, up to and including the row.

    `order` must be total inside a group. If no group is large this is one
    window. Otherwise rows are range-partitioned by (keys, order), which also
    splits a hot group; each piece is summed on its own, and what came before
    is added from a table with at most one row per piece.

    `sizes` may give the group sizes (column `_n`) where the caller has a
    cheaper way to count them.
    """
    keys, order = list(keys), list(order)
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    peak, total = sizes.agg(F.coalesce(F.max("_n"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if peak <= max_group_rows:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({f"running_{c}": F.sum(c).over(upto) for c in columns})

    spark = df.sparkSession
    pieces = chunks or max(spark.sparkContext.defaultParallelism,
                           int(spark.conf.get("spark.sql.shuffle.partitions")),
                           -(-total // max_group_rows))
    # The piece number must be the same in both branches below, hence durable().
    placed = durable(df.repartitionByRange(pieces, *keys, *order)
                       .withColumn("_piece", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (placed.groupBy(*keys, "_piece").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
               .withColumns({f"_before_{c}": F.sum(f"_{c}").over(earlier) for c in columns})
               # Only the first group of a piece can have begun in an earlier one.
               .filter(F.col(f"_before_{columns[0]}").isNotNull())
               .select(*keys, "_piece", *[f"_before_{c}" for c in columns]))
    inside = (Window.partitionBy(*keys, "_piece").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    out = (placed.withColumns({f"running_{c}": F.sum(c).over(inside) for c in columns})
           .join(F.broadcast(carried), [*keys, "_piece"], "left"))
    return out.select(*df.columns, *[
        (F.col(f"running_{c}") + F.coalesce(F.col(f"_before_{c}"), F.lit(0))).alias(f"running_{c}")
        for c in columns])


def hopping_sums(panes: DataFrame, key: str, pane_start: str, size_s: int, slide_s: int,
                 sums: Sequence[str], maxima: Sequence[str] = ()) -> DataFrame:
    """Sums and maxima of panes over the overlapping windows [hop_start, hop_start + size_s): key, hop_start and these columns.

    `pane_start` is a timestamp on a grid that divides both size and slide; windows start on multiples of `slide_s` since
    1970, and those without a pane are left out. A pane may come in several rows.

    Time is cut into blocks of one window's length. A window that starts in a block takes what lies at or after its start
    there, a running total from the block's end, and what lies before its end in the next block, one from that block's
    beginning. So a pane is shuffled twice, for its block and the one before, however many windows it is in; the windows
    themselves are made after the shuffle, and each costs two look-ups in running totals.
    """
    at = F.unix_seconds(pane_start)
    block = F.floor(at / size_s).cast("long")
    later = F.explode(F.array(F.lit(0), F.lit(1)))  # 1: the block that the windows of the one before reach into
    rows = (panes.withColumn("_later", later)
            .select(F.col(key).alias("_key"), (block - F.col("_later")).alias("_block"), "_later",
                    F.pmod(at, F.lit(size_s)).alias("_offset"), *sums, *maxima))
    group = Window.partitionBy("_key", "_block")
    start = F.col("_block") * size_s
    values = ["_later", "_offset", *sums, *maxima]
    own = F.array(F.struct(*values))
    starts = F.sequence((F.ceil(start / slide_s) * slide_s).cast("long"),
                        (F.floor((start + size_s - 1) / slide_s) * slide_s).cast("long"), F.lit(slide_s).cast("long"))
    grid = F.transform(starts, lambda s: F.struct(
        F.lit(2).alias("_later"), (s - start).alias("_offset"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in (*sums, *maxima)]))
    after = group.orderBy(F.desc("_offset")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = group.orderBy("_offset").rangeBetween(Window.unboundedPreceding, -1)
    filled = (rows.withColumn("_first", F.row_number().over(group.orderBy("_offset")) == 1)
              .withColumn("_row", F.explode(F.when(F.col("_first"), F.concat(own, grid)).otherwise(own)))
              .select("_key", "_block", "_row.*"))

    def over(f, c: str, role: int, window) -> Column:
        return f(F.when(F.col("_later") == role, F.col(c))).over(window)

    totals = filled.select(
        "_key", "_later", F.timestamp_seconds(start + F.col("_offset")).alias("hop_start"),
        (over(F.count, "_later", 0, after) + over(F.count, "_later", 1, before)).alias("_panes"),
        *[(F.coalesce(over(F.sum, c, 0, after), F.lit(0)) + F.coalesce(over(F.sum, c, 1, before), F.lit(0))).alias(c) for c in sums],
        *[F.greatest(over(F.max, c, 0, after), over(F.max, c, 1, before)).alias(c) for c in maxima])
    return totals.filter("_later = 2 and _panes > 0").select(F.col("_key").alias(key), "hop_start", *sums, *maxima)


def timeline_totals(df: DataFrame, at: str, column: str, block: Column) -> DataFrame:
    """Running sum along one global timeline, without a single-task window.

    `block` must rise with `at` (a day, say). Blocks are summed, the short
    list of block sums is accumulated, and each block runs on its own.
    """
    blocked = df.withColumn("_block", block)
    before = (blocked.groupBy("_block").agg(F.sum(column).alias("_sum"))
              .withColumn("_before", F.coalesce(
                  F.sum("_sum").over(Window.orderBy("_block")
                                     .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("_block", "_before"))
    inside = Window.partitionBy("_block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return (blocked.withColumn("_inside", F.sum(column).over(inside))
            .join(before, "_block")
            .withColumn(f"running_{column}", F.col("_inside") + F.col("_before"))
            .drop("_block", "_inside", "_before"))


def timeline_lag(df: DataFrame, at: str, columns: Sequence[str], block: Column) -> DataFrame:
    """Add `prev_<c>` from the row before on one global timeline, without a single-task window."""
    blocked = df.withColumn("_block", block)
    tails = blocked.groupBy("_block").agg(*[F.max_by(c, at).alias(f"_tail_{c}") for c in columns])
    over_blocks = Window.orderBy("_block")
    heads = tails.select("_block", *[F.lag(f"_tail_{c}").over(over_blocks).alias(f"_head_{c}")
                                     for c in columns])
    inside = Window.partitionBy("_block").orderBy(at)
    first = F.row_number().over(inside) == 1
    return (blocked.withColumns({"_first": first,
                                 **{f"prev_{c}": F.lag(c).over(inside) for c in columns}})
            .join(heads, "_block")
            .withColumns({f"prev_{c}": F.when(F.col("_first"), F.col(f"_head_{c}"))
                          .otherwise(F.col(f"prev_{c}")) for c in columns})
            .drop("_block", "_first", *[f"_head_{c}" for c in columns]))
