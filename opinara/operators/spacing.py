"""Keep an instant only if it lies far enough behind the last one kept, per key.

The rule is sequential: whether an instant stays depends on the one kept
before. A key whose instants all lie within the gap keeps its first one.
Keys with few instants are folded as short sorted lists. The time of the
others is cut into blocks of some gaps, which are walked side by side: where
does a walk that enters a block at one of the instants of its first gap end,
and what does it keep? Only these entries, a small part of all instants, are left to
walk over, and are cut into longer blocks in turn until a key is one block.

Keys with very many instants within one gap would fill a task that way. There
every instant gets a pointer to the earliest one that could follow it, and the kept
ones are those reachable from the first, found by doubling the pointers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.scaling import attach_small, few_or_shuffled
from opinara.session import durable

# Longest list folded in one row.
MAX_LIST = 2000
# A block is so many times as long as one of the level below; the lowest level's are as long as the gap.
BLOCK_GAPS = 32
# Most instants of a key within one gap that are walked in blocks; a task holds up to BLOCK_GAPS times as many.
MAX_DENSE = 100_000


def keep_spaced(df: DataFrame, key: str, ts: str, gap_s: int, max_list: int = MAX_LIST,
                pieces: int | None = None, max_dense: int = MAX_DENSE) -> DataFrame:
    """The (key, ts) pairs that stay when each must follow the last kept one by at least `gap_s`."""
    gap = gap_s * 1_000_000
    rows = df.select(key, F.unix_micros(ts).alias("t"))
    spans = durable(rows.groupBy(key).agg(F.min("t").alias("first"), F.max("t").alias("last")))
    kept = spans.filter(F.col("last") - F.col("first") < gap).select(key, F.col("first").alias("t"))
    wide = spans.filter(F.col("last") - F.col("first") >= gap)
    if not wide.isEmpty():
        kept = kept.unionByName(_spaced(rows, wide, key, gap, max_list, pieces, max_dense))
    return kept.select(key, F.timestamp_micros("t").alias(ts))


def _spaced(rows: DataFrame, wide: DataFrame, key: str, gap: int, max_list: int, pieces: int | None, max_dense: int) -> DataFrame:
    """The instants that stay of the keys in `wide` (key, first)."""
    starts = wide.select(_join_key(key), "first")
    points = durable(attach_small(rows.withColumn("_k", _join_key(key)), starts, ["_k"])
                     .filter("first is not null and t is not null").select(key, "first", "t").distinct())
    cells = points.groupBy(key, F.expr(f"(t - first) div {gap}").alias("cell")).agg(F.count("*").alias("n"))
    busy = (cells.groupBy(key).agg(F.sum("n").alias("n"), F.max("n").alias("dense")).filter(F.col("n") > max_list)
            .select(_join_key(key), F.when(F.col("dense") > max_dense, "dense").otherwise("busy").alias("kind")))
    busy = durable(busy)
    kinds = {r.kind for r in busy.select("kind").distinct().collect()}
    if not kinds:
        return _fold(points, key, gap)
    # A null key joins nothing and therefore counts as quiet only if it is; compare it explicitly.
    flagged = attach_small(points.withColumn("_k", _join_key(key)), busy, ["_k"])
    kept = _fold(flagged.filter(F.col("kind").isNull()).select(key, "t"), key, gap)
    if "busy" in kinds:
        kept = kept.unionByName(_walked(flagged.filter("kind = 'busy'").select(key, "first", "t"), key, gap))
    if "dense" in kinds:
        kept = kept.unionByName(_reach(durable(flagged.filter("kind = 'dense'").select(key, "t")), key, gap, pieces))
    return kept


def _walked(points: DataFrame, key: str, gap: int) -> DataFrame:
    """Instants that stay, by blocks of time. points: key, first (the key's first instant), t."""
    levels, span, nodes = [], gap, points.withColumn("end", F.col("t"))
    while True:
        span *= BLOCK_GAPS
        ways = durable(_ways(nodes, key, gap, span))
        levels.append(ways)
        nodes = ways.select(key, "first", "t", "end")
        if nodes.filter("t > first").isEmpty():  # every key is one block, entered at its first instant
            break
    kept = nodes.select(key, "t")
    for ways in reversed(levels):
        known = kept.select(_join_key(key), "t")
        kept = (ways.withColumn("_k", _join_key(key)).join(few_or_shuffled(known), ["_k", "t"], "left_semi")
                .select(key, F.explode("kept").alias("t")))
    return kept


def _ways(nodes: DataFrame, key: str, gap: int, span: int) -> DataFrame:
    """Where walks lead that enter a block of length `span` at an instant of its first gap, or, if none is there that is late
    enough, at the next one: t (the entry), end (the last instant kept in the block) and kept (the nodes on the way).

    nodes: key, first, t, end: a walk that comes to t keeps instants up to end, and goes on at the first node from end + gap
    on. Blocks are counted from the key's first instant, so no walk enters its first block at another one.
    """
    fields = [nodes.schema[key], T.StructField("first", T.LongType()), T.StructField("t", T.LongType()),
              T.StructField("end", T.LongType()), T.StructField("kept", T.ArrayType(T.LongType()))]

    def walk(table: pa.Table) -> pa.Table:
        t, end = (table[c].to_numpy() for c in ("t", "end"))
        order = np.argsort(t, kind="stable")
        t, end = t[order], end[order]
        first = table["first"][0].as_py()
        begin = first + (int(t[0]) - first) // span * span
        entries = np.arange(1 if begin == first else min(len(t), np.searchsorted(t, begin + gap) + 1))
        follower = np.append(np.searchsorted(t, end + gap), len(t))  # no node: len(t), which stays
        steps, at = [], entries
        while (at < len(t)).any():
            steps.append(at)
            at = follower[at]
        path = np.stack(steps, axis=1)
        on = path < len(t)
        last = path[np.arange(len(path)), on.sum(axis=1) - 1]
        offsets = np.append(0, np.cumsum(on.sum(axis=1)))
        return pa.Table.from_arrays(
            [pa.repeat(table[key][0], len(entries)), pa.repeat(pa.scalar(first, pa.int64()), len(entries)),
             pa.array(t[entries]), pa.array(end[last]), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(t[path[on]]))],
            [f.name for f in fields])

    return (nodes.withColumn("_block", F.expr(f"(t - first) div {span}")).groupBy(key, "first", "_block")
            .applyInArrow(walk, T.StructType(fields)))


def _join_key(key: str) -> Column:
    """A never-null stand-in for the key: null and text cannot collide."""
    return F.coalesce(F.concat(F.lit("v"), F.col(key).cast("string")), F.lit("n")).alias("_k")


def _fold(points: DataFrame, key: str, gap: int) -> DataFrame:
    start = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast("array<bigint>").alias("kept"))

    def step(state: Column, t: Column) -> Column:
        stays = state["last"].isNull() | (t - state["last"] >= gap)
        return F.struct(F.when(stays, t).otherwise(state["last"]).alias("last"),
                        F.when(stays, F.concat(state["kept"], F.array(t))).otherwise(state["kept"]).alias("kept"))

    return (points.groupBy(key).agg(F.array_sort(F.collect_list("t")).alias("ts"))
            .select(key, F.explode(F.aggregate("ts", start, step)["kept"]).alias("t")))


def _successors(points: DataFrame, key: str, gap: int, pieces: int | None) -> DataFrame:
    """(key, t, nxt): the earliest instant at or after t + gap; instants without one are left out.

    Instants and probes at t + gap are range-partitioned together, so a busy
    key spreads over many pieces. A probe with no instant behind it in its
    piece takes the head of the next piece that has one.
    """
    spark = points.sparkSession
    n = pieces or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = (points.select(key, F.col("t").alias("at"), F.lit(None).cast("long").alias("probe"))
             .unionByName(points.select(key, (F.col("t") + gap).alias("at"), F.col("t").alias("probe"))))
    placed = durable(marks.repartitionByRange(n, key, "at").withColumns({
        "_piece": F.spark_partition_id(), "instant": F.when(F.col("probe").isNull(), F.col("at"))}))
    behind = (Window.partitionBy(key, "_piece").orderBy("at", F.col("probe").asc_nulls_last())
              .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # On a tie the probe comes first, so an instant exactly `gap` later counts.
    near = placed.withColumn("near", F.first("instant", ignorenulls=True).over(behind)).filter(
        F.col("probe").isNotNull())
    later = Window.partitionBy(key).orderBy("_piece").rowsBetween(1, Window.unboundedFollowing)
    heads = (placed.groupBy(key, "_piece").agg(F.min("instant").alias("head"))
             .withColumn("next_head", F.first("head", ignorenulls=True).over(later))
             .select(_join_key(key), "_piece", "next_head"))
    return (attach_small(near.withColumn("_k", _join_key(key)), heads, ["_k", "_piece"])
            .select(key, F.col("probe").alias("t"), F.coalesce("near", "next_head").alias("nxt"))
            .filter(F.col("nxt").isNotNull()))


def _reach(points: DataFrame, key: str, gap: int, pieces: int | None) -> DataFrame:
    """Instants reachable from the first of their key. Each round doubles the distance covered.

    Joins are on (key, t), which is unique, so a busy key is no hot key here.
    """
    jump = durable(_successors(points, key, gap, pieces).select(_join_key(key), "t", "nxt"))
    reached = points.groupBy(key).agg(F.min("t").alias("t"))
    while not jump.isEmpty():
        there = (reached.withColumn("_k", _join_key(key)).join(jump, ["_k", "t"])
                 .select(key, F.col("nxt").alias("t")))
        reached = durable(reached.unionByName(there).distinct())
        second = jump.select("_k", F.col("t").alias("nxt"), F.col("nxt").alias("_far"))
        jump = durable(jump.join(second, ["_k", "nxt"]).select("_k", "t", F.col("_far").alias("nxt")))
    return reached.select(key, "t")
