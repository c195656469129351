"""Tumbling, late corrections and sliding windows, partly against a plain Python replay."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from opinara.operators import windows as w
from tests.conftest import at

SCHEMA = "product_id string, rating int, likes int, date timestamp, arrival_ts timestamp, seq long"
EPOCH = dt.datetime(1970, 1, 1)


def reviews(spark, rows):
    """rows of (product, rating, likes, date) or with arrival; seq is the position."""
    full = [(p, r, k, at(d), at(a[0]) if a else at(d), i) for i, (p, r, k, d, *a) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def as_tuples(df):
    return sorted(tuple(r) for r in df.withColumn("window_start", F.col("window_start").cast("string")).collect())


def test_single_and_multiple_reviews(spark):
    got = as_tuples(w.tumbling(reviews(spark, [
        ("WB-001", 4, 10, "2024-01-01 10:00:01"), ("WB-001", 5, 20, "2024-01-01 10:00:30"),
        ("WB-001", 3, 5, "2024-01-01 10:00:59.999999"), ("WB-002", 1, 0, "2024-01-01 10:00:00"),
        ("WB-001", 2, 1, "2024-01-01 10:01:00")])))
    assert got == [("WB-001", "2024-01-01 10:00:00", 4.0, 35, 3), ("WB-001", "2024-01-01 10:01:00", 2.0, 1, 1),
                   ("WB-002", "2024-01-01 10:00:00", 1.0, 0, 1)]


def test_no_review_is_lost(spark):
    rows = [(f"p{i * i % 7}", i % 4 + 1, i % 9, f"2024-03-0{1 + i % 3} 05:{i % 60:02d}:00") for i in range(173)]
    got = w.tumbling(reviews(spark, rows)).agg(F.sum("review_count"), F.sum("total_likes")).first()
    assert got[:] == (len(rows), sum(r[2] for r in rows))


def test_invalid_ratings_are_not_filtered_by_tumbling(spark):
    got = as_tuples(w.tumbling(reviews(spark, [("p", 0, 0, "2024-01-01"), ("p", 7, 0, "2024-01-01")])))
    assert got[0][2:] == (3.5, 0, 2)


@pytest.mark.parametrize("width_s", [60, 3600, 7 * 3600, 7 * 86400])
def test_boundaries_count_from_year_one(spark, width_s):
    moment = dt.datetime(2024, 5, 17, 13, 47, 31)
    since = int((moment - dt.datetime(1, 1, 1)).total_seconds())
    expected = dt.datetime(1, 1, 1) + dt.timedelta(seconds=since - since % width_s)
    got = as_tuples(w.tumbling(reviews(spark, [("p", 1, 1, str(moment))]), width_s))
    assert got[0][1] == str(expected)


@pytest.mark.parametrize("size, slide", [(0, 60), (300, 0), (-1, -1), (60, 300)])
def test_sliding_sizes_are_checked(spark, size, slide):
    with pytest.raises(ValueError):
        w.sliding(reviews(spark, [("p", 1, 1, "2024-01-01")]), size, slide)
    with pytest.raises(ValueError):
        w.tumbling_bucket("date", 0)


def test_arrival_boundaries(spark):
    day = "2024-01-01 "
    rows = [("p", 1, 0, day + "10:00:10", day + a) for a in
            ("10:01:00", "10:01:00.000001", "10:03:00", "10:03:00.000001")]
    got = w.classify_arrival(reviews(spark, rows), 60, 120).orderBy("seq").collect()
    assert [r.arrival_class for r in got] == ["on_time", "late", "late", "dropped"]


def test_late_review_corrects_a_published_window(spark):
    day = "2024-01-01 "
    got = w.tumbling_changelog(reviews(spark, [
        ("p", 4, 10, day + "10:00:10", day + "10:00:11"), ("p", 2, 5, day + "10:00:20", day + "10:01:30"),
        ("p", 5, 5, day + "10:00:20", day + "10:09:00")]), 60, 120).orderBy("emitted_at").collect()
    assert [(r.avg_rating, r.total_likes, r.review_count, r.is_update) for r in got] == [
        (4.0, 10, 1, False), (3.0, 15, 2, True)]


def replay(rows, width_s, lateness_s):
    """What a window store emits, one review at a time in arrival order."""
    width, late = dt.timedelta(seconds=width_s), dt.timedelta(seconds=lateness_s)
    start_of = lambda d: EPOCH + (d - EPOCH) // width * width
    totals, published, out = defaultdict(lambda: [0, 0, 0]), set(), []

    def emit(key, when, seq, update):
        r, k, c = totals[key]
        out.append((*key, when, seq, r, k, c, update))

    kept = [(*row, start_of(row[3])) for row in rows if row[4] <= start_of(row[3]) + width + late]
    closing = defaultdict(list)
    for row in kept:
        if row[4] <= row[6] + width:
            closing[row[0], row[6]].append(row)
    for key, members in closing.items():
        for row in members:
            totals[key] = [totals[key][0] + row[1], totals[key][1] + row[2], totals[key][2] + 1]
        emit(key, key[1] + width, max(r[5] for r in members), False)
        published.add(key[1])
    for row in sorted(kept, key=lambda r: (r[4], r[5])):
        if row[4] > row[6] + width:
            key = (row[0], row[6])
            totals[key] = [totals[key][0] + row[1], totals[key][1] + row[2], totals[key][2] + 1]
            emit(key, row[4], row[5], row[6] in published)
            published.add(row[6])
    return sorted(out)


def random_reviews(seed, n, hot_share=0.4):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        product = "HOT" if rng.random() < hot_share else f"P{rng.randrange(6)}"
        date = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(1800))
        # many equal arrival times, so the order by seq matters
        arrival = date + dt.timedelta(seconds=60 * rng.randrange(6))
        rows.append((product, rng.randrange(7), rng.randrange(-5, 50), date, arrival, seq))
    return rows


@pytest.mark.parametrize("max_group_rows", [10**6, 7])
def test_changelog_equals_replay(spark, max_group_rows):
    # Nothing arrives on time in the second window, so a late review publishes it.
    opens, closes = dt.datetime(2024, 1, 1, 0, 5), dt.datetime(2024, 1, 1, 0, 10)
    rows = [r for r in random_reviews(5, 600) if not (opens <= r[3] < closes and r[4] <= closes)]
    got = w.tumbling_changelog(spark.createDataFrame(rows, SCHEMA), 300, 120, max_group_rows)
    expected = [(p, s, e, q, float(int(abs(r / c) * 100 + 0.5)) / 100, k, c, u)
                for p, s, e, q, r, k, c, u in replay(rows, 300, 120)]
    naive = got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "emitted_at")})
    assert sorted(tuple(r) for r in naive.collect()) == expected
    assert any(not e[-1] and e[2] > e[1] + dt.timedelta(seconds=300) for e in expected)


@pytest.mark.parametrize("size, slide", [(300, 60), (300, 120), (250, 100), (60, 60)])
def test_sliding_panes_equal_plain_windows(spark, size, slide):
    data = spark.createDataFrame(random_reviews(9, 400), SCHEMA)
    plain = (data.filter("rating between 1 and 5")
             .groupBy("product_id", F.window("arrival_ts", f"{size} seconds", f"{slide} seconds").alias("x"))
             .agg(F.count("*").alias("c"), F.sum("rating").alias("r"),
                  F.count_if(F.col("rating") < 3).alias("neg"), F.max("date").alias("newest"))
             .select("product_id", "c", "r", "neg", "newest", "x.start", "x.end"))
    expected = w.finish_sliding(plain, "start", "end")
    got = w.sliding(data, size, slide)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_sliding_copies_panes_not_reviews(spark):
    """Reviews become panes, a pane is shuffled for two blocks, and windows are made only after that, whatever their number."""
    data = spark.createDataFrame(random_reviews(9, 50), SCHEMA)
    for slide in (60, 1):
        plan = w.sliding(data, 300, slide)._jdf.queryExecution().executedPlan().toString()
        windows, shuffle, blocks = (plan.index(x) for x in ("Generate explode(CASE", "Exchange hashpartitioning(_key", "Generate explode([0,1])"))
        assert windows < shuffle < blocks < plan.index("HashAggregate")


def test_absent_fields(spark):
    data = spark.createDataFrame([
        (None, 4, None, at("2024-01-01 10:00"), at("2024-01-01 10:00"), 0),
        ("p", None, 5, at("2024-01-01 10:00"), at("2024-01-01 10:00"), 1),
        ("p", 2, 5, None, at("2024-01-01 10:00:30"), 2)], SCHEMA)
    slid = {r.product_id: (r.review_count, r.latency_sec) for r in w.sliding(data, 60, 60).collect()}
    assert slid == {"unknown": (1, 60.0), "p": (1, 30.0)}
    tumbled = {r.product_id: (r.avg_rating, r.total_likes, r.review_count) for r in w.tumbling(data, 60).collect()}
    assert tumbled == {None: (4.0, 0, 1), "p": (0.0, 5, 1)}


def test_latency_is_never_negative(spark):
    # The review is dated after the window that contains its arrival.
    got = w.sliding(reviews(spark, [("p", 3, 0, "2024-01-01 11:00", "2024-01-01 10:00:30")]), 60, 60).first()
    assert got.latency_sec == 0.0
