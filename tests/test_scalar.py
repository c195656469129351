import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from opinara import functions as fn


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("v")).first().v


@pytest.mark.parametrize("value, expected", [
    (0.125, 0.13), (-0.125, -0.13), (0.375, 0.38), (2.625, 2.63), (1.005, 1.0), (7.0, 7.0), (0.004, 0.0), (0.006, 0.01),
    (4.9949, 4.99), (4.9951, 5.0), (-3.333, -3.33)])
def test_half_up(spark, value, expected):
    assert one(spark, fn.half_up(F.col("x"), 2), x=value) == expected


@pytest.mark.parametrize("value, digits, expected", [
    (0.125, 2, 0.12), (0.375, 2, 0.38), (2 / 3, 4, 0.6667), (4.0, 2, 4.0)])
def test_half_even(spark, value, digits, expected):
    assert one(spark, fn.half_even(F.col("x"), digits), x=value) == expected


def test_exact_mean_is_independent_of_order_and_skips_nulls(spark):
    values = [(0.1,), (0.2,), (0.3,), (None,)]
    for rows in (values, values[::-1]):
        df = spark.createDataFrame(rows, "x double").repartition(3)
        assert df.select(fn.exact_mean(F.col("x"), 2)).first()[0] == 0.2
    empty = spark.createDataFrame([], "x double")
    assert empty.select(fn.exact_mean(F.col("x"), 2)).first()[0] is None


def test_shorten_counts_characters(spark):
    assert one(spark, fn.shorten(F.col("s"), 3), s="жжжж") == "жжж..."
    assert one(spark, fn.shorten(F.col("s"), 3), s="жжж") == "жжж"


def test_strip_prefix(spark):
    for key, expected in (("/products/WB-1", "WB-1"), ("/products/", ""), ("other", "")):
        assert one(spark, fn.strip_prefix(F.col("k"), "/products/"), k=key) == expected


def test_bands(spark):
    got = [one(spark, fn.rating_band(F.col("r")), r=r) for r in (5.0, 4.0, 3.99, 3.0, 2.99)]
    assert got == ["green", "green", "yellow", "yellow", "red"]


@pytest.mark.parametrize("text, expected", [
    ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
    ("2024-01-02T03:04:05.250000+02:00", "2024-01-02 01:04:05.25"),
    ("2024-01-02T03:04:05", "2024-01-02 03:04:05"),
    ("1704164645000000999", "2024-01-02 03:04:05"),
    ("1.704164645E18", "2024-01-02 03:04:05"),
    ("garbage", None), ("", None), (None, None)])
def test_parse_instant(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(fn.parse_instant(F.col("s")).cast("string")).first()[0] == expected


def test_changes_and_ratios(spark):
    df = spark.createDataFrame([(4.0, 5.0), (0.0, 1.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(fn.pct_change(F.col("a"), F.col("b"))).collect()] == [25.0, None, None]
    assert [r[0] for r in df.select(fn.ratio_or_zero(F.col("b"), F.col("a"))).collect()] == [1.25, 0.0, 0.0]


def test_texts(spark):
    assert one(spark, fn.fixed_text(F.col("x"), 2), x=7.12963) == "7.13"
    assert one(spark, fn.percent_text(F.col("x"), 1), x=0.3333) == "33.3%"
    assert math.isclose(float(one(spark, fn.fixed_text(F.col("x"), 0), x=2.5)), 2.0)
