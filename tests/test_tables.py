import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opinara.operators import membership, tables
from opinara.schemas import WINDOW_SERVED
from opinara.sources import writers
from tests.conftest import at

ROWS = "product_id string, window_start timestamp, review_count long, v int"


def rows(spark, items):
    return spark.createDataFrame([(p, at(w), c, v) for p, w, c, v in items], ROWS)


def test_upsert_last_version_wins_and_is_idempotent(spark):
    old = rows(spark, [("a", "2024-01-01", 1, 0), ("b", "2024-01-01", 5, 0)])
    new = rows(spark, [("a", "2024-01-01", 2, 1), ("a", "2024-01-02", 9, 1), ("a", "2024-01-01", 3, 2)])
    once = tables.merge_latest(old, new, ["v"])
    twice = tables.merge_latest(once, new, ["v"])
    key = lambda df: sorted(map(tuple, df.select("product_id", "review_count").collect()))
    assert key(once) == key(twice) == [("a", 3), ("a", 9), ("b", 5)]
    assert once.columns == old.columns


def test_first_batch_is_deduplicated_too(spark):
    batch = rows(spark, [("a", "2024-01-01", 1, 0), ("a", "2024-01-01", 2, 1)])
    assert tables.merge_latest(batch.limit(0), batch, ["v"]).collect()[0].review_count == 2


def test_keep_last_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    plan = tables.keep_last(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


@pytest.mark.parametrize("blocks", [4096, 1])
def test_dedup_keeps_first_arrival(spark, blocks):
    df = spark.createDataFrame([("x", at("2024-01-01 00:02"), 1, "late"), ("x", at("2024-01-01 00:01"), 2, "first"),
                                ("x", at("2024-01-01 00:01"), 3, "tie"), ("y", at("2024-01-01"), 4, "only"),
                                (None, at("2024-01-01"), 5, "none"), (None, at("2024-01-02"), 6, "none again")],
                               "id string, arrival_ts timestamp, seq long, what string")
    got = tables.dedup_reviews(df, blocks)
    assert sorted((r.id or "", r.what) for r in got.collect()) == [("", "none"), ("x", "first"), ("y", "only")]
    assert got.columns == df.columns


def test_dedup_does_not_shuffle_single_reviews(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(at("2024-01-01")).alias("arrival_ts"),
                                 F.col("id").alias("seq"), F.lit("text").alias("text"))
    for side in tables.split_repeated(df):  # the filter is broadcast, rows stay where they are
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    whole = tables.dedup_reviews(df)._jdf.queryExecution().executedPlan().toString()
    single, copies = whole.split("BroadcastHashJoin")[:2]
    assert whole.count("Exchange hashpartitioning") == 1 and "partial_min_by" in whole and "Exchange hashpartitioning" not in single


def test_updates_are_flagged_per_window(spark):
    seen = rows(spark, [("a", "2024-01-01", 1, 0)])
    batch = rows(spark, [("b", "2024-01-01", 1, 0), ("b", "2024-01-02", 1, 0)])
    got = tables.mark_updates(batch, seen).orderBy("window_start").collect()
    assert [r.is_update for r in got] == [True, False]


def test_emissions_are_kept_in_the_order_of_arrival(spark):
    """An old window that is corrected late counts as new; equal instants go by number."""
    df = spark.createDataFrame([(1, "10:00", 1), (2, "10:05", 2), (1, "10:05", 3), (0, "10:04", 9)],
                               "w int, emitted_at string, seq int")
    kept = tables.retain_last_emitted(df, 3).orderBy("position").collect()
    assert [(r.w, r.seq, r.position) for r in kept] == [(0, 9, 1), (2, 2, 2), (1, 3, 3)]
    assert tables.retain_last_emitted(df.limit(0), 3).count() == 0


def test_retention_by_count_and_age(spark):
    df = rows(spark, [("a", f"2024-01-0{d}", d, d) for d in range(1, 10)])
    assert [r.v for r in tables.retain_last(df, 5, ["v"]).collect()] == [5, 6, 7, 8, 9]
    assert tables.retain_last(df, 50, ["v"]).count() == 9
    kept = tables.retain_since(df, "2024-01-09", 2 * 86400)
    assert sorted(r.v for r in kept.collect()) == [7, 8, 9]


def test_age_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "w")
    rows(spark, [("a", "2024-01-01", 1, 1)]).write.parquet(path)
    plan = tables.retain_since(spark.read.parquet(path), "2024-01-09", 86400)
    assert "GreaterThanOrEqual(window_start" in plan._jdf.queryExecution().executedPlan().toString()


def test_same_rows_counts_multiplicity_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, s string")
    b = spark.createDataFrame([(2, "x"), (1, None)], "k int, s string")
    assert tuple(tables.same_rows(a, b).first()) == (1, 0, False)
    assert tuple(tables.same_rows(a, a.orderBy("k")).first()) == (0, 0, True)
    assert tuple(tables.same_rows(a.limit(0), b.limit(0)).first()) == (0, 0, True)


def window_rows(spark, items):
    return spark.createDataFrame([(p, at(w), 3.0, 1, c) for p, w, c in items], WINDOW_SERVED)


def append(rows, root, batch_id):
    writers.append_batch(rows, root, batch_id, "window_start")


def test_window_table_versions_repeat_and_compact(spark, tmp_path):
    root = str(tmp_path / "table")
    read = lambda where: {(r.product_id, str(r.window_start)): r.review_count
                          for r in writers.latest_windows(spark, where, WINDOW_SERVED).collect()}
    append(window_rows(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 4)]), root, 0)
    append(window_rows(spark, [("a", "2024-01-01", 2)]), root, 1)
    append(window_rows(spark, [("a", "2024-01-01", 3)]), root, 1)  # the batch is repeated
    expected = {("a", "2024-01-01 00:00:00"): 3, ("b", "2024-01-02 00:00:00"): 4}
    assert read(root) == expected
    target = str(tmp_path / "compacted")
    writers.compact_windows(spark, root, WINDOW_SERVED, target)
    assert read(target) == expected
    assert writers.read_versions(spark, target, WINDOW_SERVED).count() == 2
    append(window_rows(spark, [("a", "2024-01-01", 9)]), target, 2)
    assert read(target)["a", "2024-01-01 00:00:00"] == 9


def test_window_table_prunes_days(spark, tmp_path):
    root = str(tmp_path / "table")
    append(window_rows(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 4), ("c", "2024-01-05", 2)]), root, 0)
    day = dt.date(2024, 1, 2)
    recent = writers.latest_windows(spark, root, WINDOW_SERVED, day)
    assert sorted(r.product_id for r in recent.collect()) == ["b", "c"]
    assert "day" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    # With both ends given only the folders of those days are listed.
    named = writers.read_versions(spark, root, WINDOW_SERVED, day, dt.date(2024, 1, 4))
    assert [r.product_id for r in named.collect()] == ["b"]
    assert all("day=2024-01-02" in f for f in named.inputFiles())
    assert writers.read_versions(spark, root, WINDOW_SERVED, dt.date(2023, 1, 1), dt.date(2023, 1, 2)).count() == 0
    assert writers.read_versions(spark, str(tmp_path / "nothing"), WINDOW_SERVED).count() == 0
    target = str(tmp_path / "kept")
    writers.compact_windows(spark, root, WINDOW_SERVED, target, first_day=day)
    assert writers.latest_windows(spark, target, WINDOW_SERVED).count() == 2


def test_a_busy_day_is_written_by_several_tasks(spark, tmp_path):
    """A day beyond the advisory size is split; how often follows from its bytes."""
    root, size = str(tmp_path / "table"), 64 << 10
    rows = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
                                      F.lit("2024-01-01").cast("timestamp").alias("window_start"),
                                      F.lit(1.0).alias("avg_rating"), F.lit(1).cast("long").alias("total_likes"),
                                      F.lit(1).cast("long").alias("review_count"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    try:
        append(rows, root, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = writers.read_versions(spark, root, WINDOW_SERVED)
    # Ids of 64 random digits shrink to a half at best, so there are over 40,000 * 32 bytes to write.
    assert len(stored.inputFiles()) >= 4 and 40_000 * 32 > 4 * size
    assert stored.count() == 40_000


KINDS = "a string, b string, n long, x double"


def test_equality_of_multisets(spark):
    rng = random.Random(4)
    value = lambda: (rng.choice(["p", "q", "", None]), rng.choice(["p", None]), rng.choice([1, 2, None]), rng.choice([0.0, 1.5, float("nan"), None]))
    base = [value() for _ in range(3000)]
    shuffled = rng.sample(base, len(base))
    frame = lambda rows, parts: spark.createDataFrame(rows, KINDS).repartition(parts)
    one = lambda l, r: tuple(tables.same_rows(l, r).first())
    assert one(frame(base, 3), frame(shuffled, 7)) == (0, 0, True)
    assert one(frame(base, 3), frame(base[1:], 3)) == (1, 0, False)
    assert one(frame([*base, base[0]], 3), frame(base, 3)) == (1, 0, False)  # multiplicity counts
    others = [("only", None, 5, 1.0), ("only", None, 5, 1.0)]
    assert one(frame([*base, *others], 3), frame([*base[5:], others[0]], 3)) == (6, 0, False)
    assert one(frame([(None, "p", 1, None)], 1), frame([("p", None, 1, None)], 1)) == (1, 1, False)  # absent values have a place
    none = frame(base, 1).limit(0)
    assert one(none, none) == (0, 0, True) and one(none, frame(base[:4], 2)) == (0, 4, False)
    assert one(frame(base, 2), frame(base, 2).select("x", "n", "b", "a")) == (0, 0, True)
    assert one(spark.range(3).toDF("v"), spark.range(3).selectExpr("cast(id as int) as v")) == (0, 0, True)


def test_equal_results_are_not_shuffled(spark):
    """Every task sends one row of sums."""
    plan = tables.multiset_hash(spark.range(100).withColumn("t", F.lit("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" in plan and "hashpartitioning" not in plan and "partial_sum" in plan


@pytest.mark.parametrize("blocks", [4096, 3, 1])
def test_filter_of_keys(spark, blocks):
    keys = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("id")).union(spark.createDataFrame([(None,)], "id string"))
    rows = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("n"), F.lit("x").alias("block")).union(
        spark.createDataFrame([(None, -1, "x"), (None, -2, "x")], "id string, n long, block string"))
    maybe, others = membership.split_by_filter(rows, "id", membership.bloom_filter(keys, blocks), blocks)
    inside, outside = ({r.n for r in side.collect()} for side in (maybe, others))
    assert len(inside) + len(outside) == 6002 and not inside & outside
    assert inside >= {*range(0, 3000, 3), -1, -2}
    assert len(inside) - 1002 <= {4096: 5, 3: 100, 1: 600}[blocks]
    none = membership.bloom_filter(keys.limit(0), blocks)
    assert membership.split_by_filter(rows, "id", none, blocks)[0].count() == 0


def test_ids_within_the_horizon_are_not_spaced(spark, monkeypatch):
    """An aggregate finds the first review of an id whose reviews lie within the horizon; no pointers, no lists."""
    monkeypatch.setattr(tables, "keep_spaced", lambda *_: pytest.fail("ids within the horizon were spaced"))
    rows = spark.createDataFrame([("a", 5, 2), ("a", 5, 1), ("a", 100, 3), ("b", 7, 4), (None, 9, 6), (None, 8, 5), ("c", None, 7)],
                                 "id string, s long, seq long").withColumn("arrival_ts", F.timestamp_seconds("s"))
    assert sorted(r.seq for r in tables.first_within(rows, 120).collect()) == [1, 4, 5]
