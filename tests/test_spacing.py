"""Greedy spacing, by list and by pointer doubling, against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from opinara.operators import tables
from opinara.operators.spacing import keep_spaced


def greedy(times, gap):
    kept, last = [], None
    for t in sorted(set(times)):
        if last is None or t - last >= gap:
            kept.append(t)
            last = t
    return kept


@pytest.mark.parametrize("max_list, pieces", [(10_000, None), (5, 2), (5, 9), (150, 3)])
def test_equals_a_loop(spark, max_list, pieces):
    rng = random.Random(max_list)
    keys = {"hot": [rng.randrange(4000) for _ in range(1500)], "even": list(range(0, 2000, 10)), "one": [7],
            None: [rng.randrange(900) for _ in range(60)], "far": [0, 5000, 100_000]}
    rows = [(k, t) for k, ts in keys.items() for t in ts]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = keep_spaced(df, "k", "ts", 30, max_list, pieces).select("k", F.unix_seconds("ts").alias("s")).collect()
    expected = [(k, t) for k, ts in keys.items() for t in greedy(ts, 30)]
    order = lambda r: (r[0] or "", r[1])
    assert sorted(map(tuple, got), key=order) == sorted(expected, key=order)


def test_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, ts timestamp")
    assert keep_spaced(empty, "k", "ts", 30).count() == 0


@pytest.mark.parametrize("blocks", [4096, 1])
def test_dedup_horizon_counts_from_the_accepted_copy(spark, blocks):
    seconds = [("a", 0), ("a", 119), ("a", 120), ("a", 121), ("a", 239), ("a", 240), ("b", 5), ("a", 0), (None, 1), (None, 2)]
    df = spark.createDataFrame([(i, s, n) for n, (i, s) in enumerate(seconds)], "id string, s long, seq long")
    df = df.withColumn("arrival_ts", F.timestamp_seconds("s"))
    got = tables.dedup_within(df, 120, blocks=blocks)
    assert got.columns == df.columns
    assert sorted(r.seq for r in got.collect()) == [0, 2, 5, 6, 8]


@pytest.mark.parametrize("max_dense", [100_000, 3])
def test_busy_keys_over_several_levels_equal_a_loop(spark, max_dense):
    rng = random.Random(3)
    keys = {"long": rng.sample(range(-400_000, 400_000), 4000), None: rng.sample(range(200_000), 2500), "even": list(range(0, 60_000, 15)),
            "first": [0, *range(5 * 30 * 32, 5 * 30 * 32 + 900)], "within": [5, 6, 7, 30]}
    rows = [(k, t) for k, ts in keys.items() for t in ts]
    df = spark.createDataFrame(rows, "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = keep_spaced(df, "k", "ts", 30, 100, 3, max_dense).select("k", F.unix_seconds("ts").alias("s")).collect()
    expected = [(k, t) for k, ts in keys.items() for t in greedy(ts, 30)]
    order = lambda r: (r[0] or "", r[1])
    assert sorted(map(tuple, got), key=order) == sorted(expected, key=order)


def test_a_busy_key_is_walked_in_few_rounds(spark, monkeypatch):
    """The number of jobs follows from the levels of blocks, not from the doubling of pointers over all instants."""
    from opinara.operators import spacing
    monkeypatch.setattr(spacing, "_reach", lambda *_: pytest.fail("pointers were doubled over all instants"))
    df = spark.range(50_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("ts"))
    assert keep_spaced(df, "k", "ts", 60).count() == 50_000 // 9 + 1
