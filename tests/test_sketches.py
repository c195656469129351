"""Sketches per interval: merging changes nothing, and errors stay within the stated bounds."""

import random
from collections import Counter

from pyspark.sql import functions as F

from opinara.operators import sketches

DAY = 86_400


def reviews(spark, rows):
    return spark.createDataFrame(rows, "id string, product_id string, day int").withColumn(
        "date", F.timestamp_seconds(F.col("day") * DAY + 5)).drop("day").repartition(5)


def test_merged_sketches_equal_one_sketch_of_all(spark):
    rng = random.Random(1)
    rows = [(f"r{rng.randrange(9000)}", rng.choice(["a", "b", None]), rng.randrange(12)) for _ in range(12_000)]
    df = reviews(spark, rows)
    whole = sketches.distinct_counts(sketches.merged(sketches.interval_sketches(df, 12 * DAY))).first()
    parts = sketches.distinct_counts(sketches.merged(sketches.interval_sketches(df, DAY))).first()
    assert parts.reviews == whole.reviews == 12_000
    exact = len({r[0] for r in rows})
    assert whole.ids_low <= exact <= whole.ids_high and parts.ids_low <= exact <= parts.ids_high
    assert parts.products == whole.products == 3


def test_rolling_spans(spark):
    df = reviews(spark, [("x", "a", 10), ("y", "a", 12), ("z", "b", 20)])
    got = sketches.distinct_counts(sketches.rolling(sketches.interval_sketches(df, DAY), DAY, 3))
    rows = {int(r.span_start.timestamp()) // DAY: (r.reviews, r.ids) for r in got.collect()}
    assert rows == {8: (1, 1), 9: (1, 1), 10: (2, 2), 11: (1, 1), 12: (1, 1), 18: (1, 1), 19: (1, 1), 20: (1, 1)}


def test_top_products_beyond_the_tracked_ones(spark):
    """Many more products than entries: the frequent ones are found, off by no more than stated."""
    rng = random.Random(2)
    rows = [(str(i), f"p{int(rng.paretovariate(0.7))}", rng.randrange(4)) for i in range(20_000)]
    exact = Counter(p for _, p, _ in rows)
    days = sketches.interval_sketches(reviews(spark, rows), DAY, tracked=64)
    got = sketches.top_counts(sketches.merged(days, F.lit("all").alias("span"), tracked=64), "span", 5, tracked=64).collect()
    assert len(exact) > 500 and len(got) == 5
    for r in got:
        assert 0 <= r.max_error <= 20_000 * 3.5 / 64 + 1 and abs(r.n - exact[r.product_id]) <= r.max_error
    assert got[0].product_id == exact.most_common(1)[0][0]


def test_few_products_are_exact_and_nothing_gives_nothing(spark):
    df = reviews(spark, [("1", "a", 0), ("2", "b", 0), ("3", "b", 1), ("4", None, 1)])
    days = sketches.interval_sketches(df, DAY)
    rows = sketches.top_counts(sketches.merged(days, F.lit(1).alias("one")), "one", 2).collect()
    assert [(r.product_id, r.n, r.max_error) for r in rows] == [("b", 2, 0), ("a", 1, 0)]
    assert sketches.rolling(sketches.interval_sketches(df.limit(0), DAY), DAY, 7).count() == 0
