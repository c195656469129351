"""Shape of the physical plans: shuffles, pushed filters, columns read, no Python in the way."""

import re

import pytest
from pyspark.sql import functions as F

from opinara.plans.catalog import CATALOG
from opinara.operators import dashboards, quality, stats, tables
from opinara.operators import windows as w
from opinara.plans import fixtures as fx

QUERIES = CATALOG  # the review queries


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                          plan_of(df)))


@pytest.fixture(scope="module")
def reviews(spark, sf_small):
    return fx.reviews(spark, sf_small)


def test_one_shuffle_for_keyed_aggregates(reviews):
    for df in (w.tumbling(reviews, 60), stats.top_products(reviews), tables.dedup_reviews(reviews),
               stats.review_stats(reviews), stats.rating_distribution(reviews), stats.moving_rate(reviews).limit(1)):
        assert shuffles(df) <= 2
    assert shuffles(w.tumbling(reviews, 60)) == 1
    assert shuffles(w.sliding(reviews, 300, 60)) == 2


def test_validation_needs_no_shuffle(reviews):
    df = quality.annotate_validity(reviews.withColumn("text", F.lit("x")), "rating_f")
    assert shuffles(df) == 0 and "Window" not in plan_of(df)


def test_no_window_over_raw_rows_in_one_task(reviews):
    """Global running sums and lags partition by block; only block summaries meet in one task."""
    for df in (stats.throughput(reviews, 3600), stats.throughput_delta(stats.throughput(reviews, 3600)),
               stats.moving_rate(reviews), dashboards.latency_series(w.sliding(reviews, 86400, 21600))):
        for single in re.findall(r"Window .*", plan_of(df)):
            assert "_block" in single


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_row_products(spark, sf_small, name):
    plan = plan_of(QUERIES[name](spark, sf_small))
    for word in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_scans_read_only_needed_columns(reviews):
    plan = plan_of(stats.run_totals(reviews))
    assert re.search(r"ReadSchema: struct<user_id:bigint>", plan)
    assert "documents" not in plan
