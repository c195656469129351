"""What a filter reads of the window table."""

import pytest
from pyspark.sql import functions as F

from opinara.operators import serving
from opinara.operators.tables import WINDOW_KEY
from opinara.schemas import WINDOW_AGG
from opinara.sources import writers

ROWS, PRODUCTS = 120_000, 1_500


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    """The same windows of one day, unordered and clustered; products do not follow from the time."""
    i = F.col("id")
    rows = spark.range(ROWS).select(
        F.format_string("P-%05d", 2 * F.pmod(F.xxhash64(i), F.lit(PRODUCTS))).alias("product_id"),
        F.timestamp_micros(1_704_067_200_000_000 + i * 700_000).alias("window_start"), (i % 5).cast("double").alias("avg_rating"),
        i.alias("total_likes"), F.lit(1).cast("long").alias("review_count"), F.lit(False).alias("is_update"))
    base = str(tmp_path_factory.mktemp("layout"))
    writers.append_batch(rows, f"{base}/plain", 0, "window_start")
    writers.append_batch(rows, f"{base}/clustered", 0, "window_start", cluster=WINDOW_KEY)
    return f"{base}/plain", f"{base}/clustered"


def rows_read(df):
    """Rows of the result, and rows that came out of its scan."""
    found = len(df.collect())
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return found, scan.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("select", [lambda df: serving.filter_exact(df, "P-01000"), lambda df: serving.filter_prefix(df, "P-010")])
def test_a_filter_reads_a_part_of_a_clustered_table(spark, roots, select):
    (found, plain), (same, clustered) = (rows_read(select(writers.read_versions(spark, root, WINDOW_AGG))) for root in roots)
    assert found == same > 0
    assert plain == ROWS and clustered <= ROWS / 4


def test_an_unknown_product_between_known_ones_reads_nothing(spark, roots):
    assert rows_read(serving.filter_exact(writers.read_versions(spark, roots[1], WINDOW_AGG), "P-01001")) == (0, 0)


def test_the_filter_reaches_the_scan_below_the_choice_of_versions(spark, roots):
    plan = serving.filter_exact(writers.latest_windows(spark, roots[1], WINDOW_AGG), "P-01000")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(product_id,P-01000)" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_clustered_and_plain_tables_hold_the_same(spark, roots):
    plain, clustered = (writers.latest_windows(spark, root, WINDOW_AGG) for root in roots)
    assert plain.exceptAll(clustered).count() == 0 == clustered.exceptAll(plain).count()


def test_empty_batches_and_missing_products(spark, tmp_path):
    root, row = str(tmp_path / "t"), "select cast(null as string) as product_id, timestamp'2024-01-01' as window_start, 1d as avg_rating, 1L as total_likes, 1L as review_count, false as is_update"
    rows = spark.sql(row)
    writers.append_batch(rows.filter("false"), root, 0, "window_start", cluster=WINDOW_KEY)
    writers.append_batch(rows, root, 1, "window_start", cluster=WINDOW_KEY)
    assert writers.read_versions(spark, root, WINDOW_AGG).count() == 1
