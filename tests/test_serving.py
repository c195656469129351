import json

import pytest
from pyspark.sql import functions as F

from opinara.operators import dashboards, serving
from opinara.schemas import SLIDING_AGG, WINDOW_AGG
from tests.conftest import at


@pytest.fixture(scope="module")
def windows(spark):
    return spark.createDataFrame(
        [("shoe-7", at("2024-03-05 08:00"), 3.5, 12, 4, False), ("shoe-7", at("2024-03-05 08:05"), 1.75, 0, 8, True),
         ("shoe-71", at("2024-03-05 08:00"), 4.0, -1, 3, False), ("lamp-2", at("2024-03-05 09:30"), 2.25, 6, 2, False)],
        WINDOW_AGG)


@pytest.mark.parametrize("product, n", [("shoe-7", 3), ("shoe-71", 1), ("", 4), ("desk", 0), ("shoe-", 3)])
def test_prefix_filter(windows, product, n):
    assert serving.filter_prefix(windows, product).count() == n


@pytest.mark.parametrize("product, n", [("shoe-7", 2), ("shoe-", 0), ("All", 4), ("", 0)])
def test_exact_filter(windows, product, n):
    assert serving.filter_exact(windows, product).count() == n


@pytest.mark.parametrize("ticket, n", [
    ('{"cmd": "all"}', 4), ('{"cmd": "filter", "product_id": "lamp-2"}', 1), ('{"cmd": "filter"}', 4),
    ('{"cmd": "refresh", "product_id": "lamp-2"}', 4), ("{}", 4), (b'{"cmd": "all"}', 4)])
def test_tickets(windows, ticket, n):
    assert serving.query_windows(windows, ticket).count() == n


@pytest.mark.parametrize("ticket", ["shoe-7", "", "[1]", '{"cmd": 3}', b"\xff"])
def test_bad_tickets(windows, ticket):
    with pytest.raises(ValueError, match="bad ticket"):
        serving.query_windows(windows, ticket)


def test_tickets_from_paths():
    assert json.loads(serving.ticket_for_path(["windows"])) == {"cmd": "all"}
    assert json.loads(serving.ticket_for_path(["windows", "lamp"])) == {"cmd": "filter", "product_id": "lamp"}


def test_filters_reach_the_scan(spark, windows, tmp_path):
    path = str(tmp_path / "w")
    windows.write.parquet(path)
    read = spark.read.schema(WINDOW_AGG).parquet(path)
    plan = serving.serve_projection(serving.filter_prefix(read, "shoe-"))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(product_id,shoe-)" in plan
    scanned = next(line for line in plan.splitlines() if "ReadSchema" in line).split("ReadSchema")[1]
    assert "is_update" not in scanned


def test_served_columns(windows):
    served = serving.serve_projection(windows)
    assert [(f.name, f.dataType.simpleString()) for f in served.schema] == [
        ("product_id", "string"), ("window_start", "timestamp"), ("avg_rating", "double"),
        ("total_likes", "bigint"), ("review_count", "bigint")]


def test_arrow_batches(spark, windows):
    batches = list(serving.arrow_batches(spark.range(2500).repartition(1).select("id"), 1000))
    assert [b.num_rows for b in batches] == [1000, 1000, 500]
    assert sorted(v for b in batches for v in b.column(0).to_pylist()) == list(range(2500))
    empty = list(serving.arrow_batches(serving.filter_prefix(windows, "desk")))
    assert [b.num_rows for b in empty] == [0] and empty[0].schema.names == windows.columns
    got = next(serving.arrow_batches(serving.filter_exact(windows, "lamp-2")))
    assert got.column("window_start").to_pylist()[0].isoformat() == "2024-03-05T09:30:00+00:00"


def test_payload(spark, windows):
    one = serving.payload_bytes(serving.filter_exact(windows, "lamp-2")).first()
    text = ('{"product_id":"lamp-2","window_start":"2024-03-05T09:30:00.000000Z","avg_rating":2.25,'
            '"total_likes":6,"review_count":2}')
    assert tuple(one) == (1, len(text), 36 + 4 + 6)
    assert tuple(serving.payload_bytes(windows.limit(0)).first()) == (0, 0, 4)


def slides(spark, rows):
    full = [(at("2024-01-01 09:00"), at(t), at(t), p, n, a, s, at("2024-01-01 09:30"), lat)
            for p, t, n, a, s, lat in rows]
    return spark.createDataFrame(full, SLIDING_AGG)


def test_latest_takes_last_known_value_per_column(spark):
    df = slides(spark, [("a", "2024-01-01 10:00", 5, 4.0, 0.5, 1.0), ("a", "2024-01-01 10:01", 6, None, 0.25, 2.0)])
    got = dashboards.latest_per_product(df).first()
    assert (got.review_count, got.avg_rating, got.negative_share) == (6, 4.0, 0.25)


def test_latest_kpis(spark):
    df = slides(spark, [("a", "2024-01-01 10:00", 5, 4.0, 0.5, 9.0), ("a", "2024-01-01 10:01", 6, 3.0, 0.25, 1.5),
                        ("b", "2024-01-01 10:00", 10, 5.0, 0.0, 7.0)])
    got = dashboards.kpi_latest(df).first()
    assert tuple(got) == (4.0, 16, 12.5, 1.5)
    top = dashboards.top_latest(df, 1).first()
    assert (top.product_id, top.review_count) == ("b", 10)


def test_window_kpis(windows):
    assert tuple(dashboards.kpi_windows(windows).first()) == (4, 3, 2.875, 17)
    assert dashboards.kpi_windows(windows, approximate=True).first().products == 3
    weighted = {r.product_id: r.weighted_rating for r in dashboards.weighted_rating(windows).collect()}
    assert weighted["shoe-7"] == pytest.approx((3.5 * 4 + 1.75 * 8) / 12)


def test_latency_series_is_relative_to_the_newest(spark):
    df = slides(spark, [("a", "2024-01-01 10:00", 1, 4.0, 0.0, 9.0), ("a", "2024-01-01 10:30", 1, 4.0, 0.0, 1.0),
                        ("b", "2024-01-01 10:30", 1, 4.0, 0.0, 2.0), ("a", "2024-01-01 09:59", 1, 4.0, 0.0, 5.0)])
    assert [r.latency_sec for r in dashboards.latency_series(df).collect()] == [9.0, 1.5]
    assert dashboards.current_latency(df).first().latency_sec == 1.5


def test_display_tables(spark, windows):
    df = slides(spark, [("a", "2024-01-01 10:00", 1, 4.0, 0.123, 9.04), ("b", "2024-01-01 10:01", 1, 3.456, 0.0, 1.0)])
    assert [tuple(r) for r in dashboards.recent_table(df, 1).collect()] == [
        ("b", 1, "3.46", "0.0%", "1.0s", "10:01:00")]
    assert dashboards.windows_newest(windows).first().window_time == "09:30:00"
    assert [r.product_id for r in dashboards.windows_sorted(windows, 2).collect()] == ["shoe-7", "shoe-71"]


def test_series_for_one_product(spark):
    df = slides(spark, [("a", "2024-01-01 10:01", 1, 4.0, 0.5, 9.0), ("a", "2024-01-01 10:00", 1, 3.0, 0.25, 9.0),
                        ("b", "2024-01-01 10:00", 1, 1.0, 1.0, 9.0)])
    got = dashboards.product_series(df, "a").collect()
    assert [(r.avg_rating, r.negative_pct) for r in got] == [(3.0, 25.0), (4.0, 50.0)]
    assert [r.product_id for r in dashboards.product_list(df).select(F.col("product_id")).collect()] == ["a", "b"]
