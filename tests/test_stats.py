import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinara.operators import stats
from opinara.schemas import RUN_SUMMARY
from tests.conftest import at

REVIEWS = "id string, product_id string, rating int, arrival_ts timestamp, seq long"


def arrivals(spark, seconds):
    base = dt.datetime(2024, 1, 1)
    rows = [(f"r{i}", "p", 3, base + dt.timedelta(seconds=s), i) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, REVIEWS)


def rated(spark, pairs):
    return spark.createDataFrame([(f"r{i}", p, r, at("2024-01-01"), i) for i, (p, r) in enumerate(pairs)], REVIEWS)


def test_cumulative_stats_count_invalid_ratings_apart(spark):
    got = stats.review_stats(rated(spark, [("a", 5), ("a", 4), ("b", 0), ("b", 6)])).first()
    assert tuple(got) == (4, 2, 2, 4.5)
    assert tuple(stats.review_stats(rated(spark, [])).first()) == (0, 0, 0, 0.0)
    assert stats.review_stats(rated(spark, [("a", 9)])).first().avg_rating == 0.0


def test_distribution_has_five_rows(spark):
    got = [tuple(r) for r in stats.rating_distribution(rated(spark, [("a", 5), ("a", 5), ("a", 1), ("a", 0)]))
           .orderBy("rating").collect()]
    assert [(r, n) for r, n, _ in got] == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 2)]
    assert sum(p for *_, p in got) == pytest.approx(100)
    assert [r.pct for r in stats.rating_distribution(rated(spark, [])).collect()] == [0.0] * 5


def test_top_products_break_ties_by_first_seen(spark):
    pairs = [("z", 1), ("a", 1), ("a", 0), ("z", 9), ("m", 3)]
    assert [tuple(r) for r in stats.top_products(rated(spark, pairs), 2).collect()] == [("z", 2), ("a", 2)]


def test_last_reviews(spark):
    got = stats.last_reviews(rated(spark, [("a", i) for i in range(9)])).collect()
    assert [r.seq for r in got] == [8, 7, 6, 5, 4]


def test_defaults(spark):
    got = stats.fill_defaults(rated(spark, [(None, None), ("a", 2)])).orderBy("seq").collect()
    assert [(r.product_id, r.rating) for r in got] == [("unknown", 0), ("a", 2)]


def test_throughput_has_empty_intervals_and_running_total(spark):
    got = stats.throughput(arrivals(spark, [0, 1, 4, 16]), 5).orderBy("snapshot_at").collect()
    assert [(r.elapsed_s, r.total_reviews, r.reviews_per_sec) for r in got] == [
        (5.0, 3, 0.6), (10.0, 3, 0.0), (15.0, 3, 0.0), (20.0, 4, 0.2)]
    again = stats.throughput_delta(stats.throughput(arrivals(spark, [0, 1, 4, 16]), 5)).orderBy("snapshot_at")
    assert [(r.new_reviews, r.reviews_per_sec) for r in again.collect()] == [(3, 0.0), (0, 0.0), (0, 0.0), (1, 0.2)]


def test_throughput_of_nothing(spark):
    assert all(r.total_reviews == 0 for r in stats.throughput(arrivals(spark, []), 5).collect())


def test_run_summary(spark):
    got = stats.run_summary(stats.throughput(arrivals(spark, [0, 1, 4, 16]), 5)).first()
    assert (got.duration_s, got.total_reviews, got.peak_rps) == (20.0, 4, 0.6)
    assert got.avg_rps == pytest.approx(0.2)


def test_moving_rate_against_a_sample_list(spark):
    rng = random.Random(1)
    seconds = sorted(rng.choices(range(60), k=80))
    counts, total, samples, expected = Counter(seconds), 0, [], {}
    for s in sorted(counts):
        total += counts[s]
        samples = [x for x in [*samples, (s, total)] if x[0] >= s - 5]
        grown, span = total - samples[0][1], s - samples[0][0]
        expected[s] = (grown, grown / span if span else 0.0)
    got = {int((r.sampled_at - dt.datetime(2024, 1, 1)).total_seconds()): (r.new_reviews, r.reviews_per_sec)
           for r in stats.moving_rate(arrivals(spark, seconds))
           .withColumn("sampled_at", F.col("sampled_at").cast("timestamp_ntz")).collect()}
    assert got == expected


def test_run_totals(spark):
    got = {tuple(r) for r in stats.run_totals(rated(spark, [("a", 1), ("b", 2), ("a", 3)])).collect()}
    assert got == {("a", 2), ("b", 1), ("TOTAL", 3)}


def test_compare_runs(spark):
    schema = "metric string, value double"
    base = spark.createDataFrame([("rps", 100.0), ("zero", 0.0), ("only_base", 1.0)], schema)
    other = spark.createDataFrame([("rps", 125.0), ("zero", 5.0), ("only_other", 2.0)], schema)
    got = {r.metric: (r.change_pct, r.ratio) for r in stats.compare_runs(base, other).collect()}
    assert got["rps"] == (25.0, 1.25)
    assert got["zero"][0] is None and got["only_base"][0] is None and got["only_other"][0] is None


def test_parse_summaries(spark):
    lines = [("a", 'x\nSUMMARY_JSON: {"language": "go", "rps": 1.5,\n "total_reviews": 7}'),
             ("b", "nothing here"), ("c", "SUMMARY_JSON: {broken}"), ("d", 'SUMMARY_JSON:{"peak_rps": 2.0}')]
    got = {r.run: r for r in stats.parse_summaries(
        spark.createDataFrame(lines, "run string, line string"), RUN_SUMMARY).collect()}
    assert (got["a"].language, got["a"].rps, got["a"].total_reviews, got["a"].error) == ("go", 1.5, 7, None)
    assert got["b"].error == got["c"].error == "no summary"
    assert (got["d"].peak_rps, got["d"].error) == (2.0, None)


def test_backlog_joins_distinct_ids(spark):
    products = spark.createDataFrame([("a",), ("b",), ("c",)], "product_id string")
    taken = spark.createDataFrame([("a",)] * 100 + [("z",)], "product_id string")
    assert sorted(r[0] for r in stats.product_backlog(products, taken).collect()) == ["b", "c"]


def test_moving_rate_refuses_a_span_between_steps(spark):
    empty = spark.createDataFrame([], "arrival_ts timestamp")
    with pytest.raises(ValueError):
        stats.moving_rate(empty, span_s=5, step_s=2)
    assert stats.moving_rate(empty, span_s=6, step_s=2).count() == 0
