import pytest
from pyspark.sql import functions as F

from opinara.functions import register_sql_functions
from opinara.operators import quality
from opinara.schemas import CANDIDATE_REVIEW

RATING = "rating must be between 1.0 and 5.0, got "

CASES = [
    # rating, text, likes, error_code, error_msg
    (3.0, "fine", 10, "", ""),
    (1.0, "low bound", 0, "", ""),
    (5.0, "high bound", 0, "", ""),
    (0.9, "x", 0, "rating", RATING + "0.9"),
    (5.1, "x", 0, "rating", RATING + "5.1"),
    (-1.0, "x", 0, "rating", RATING + "-1.0"),
    (6.0, "", -1, "rating", RATING + "6.0"),
    (float("nan"), "x", 0, "rating", RATING + "nan"),
    (float("inf"), "x", 0, "rating", RATING + "Infinity"),
    (3.0, "", 0, "empty_text", "text must not be empty"),
    (3.0, "", -1, "empty_text", "text must not be empty"),
    (3.0, "   ", 0, "", ""),
    (3.0, "ж" * 5000, 0, "", ""),
    (3.0, "ж" * 5001, 0, "long_text", "text too long: 5001 chars, max 5000"),
    (3.0, "x" * 5001, -1, "long_text", "text too long: 5001 chars, max 5000"),
    (3.0, "😀" * 5000, 0, "", ""),
    (3.0, "x", -1, "likes", "likes must be >= 0, got -1"),
    (3.0, "x", 0, "", ""),
    (None, "x", 0, "null_field", "rating, text and likes must not be null"),
    (3.0, None, 0, "null_field", "rating, text and likes must not be null"),
    (3.0, "x", None, "null_field", "rating, text and likes must not be null"),
]


@pytest.fixture(scope="module")
def candidates(spark):
    return spark.createDataFrame([(str(i), "WB-001", *case[:3]) for i, case in enumerate(CASES)], CANDIDATE_REVIEW)


def test_first_error_wins(candidates):
    got = {int(r.review_id): r for r in quality.annotate_validity(candidates).collect()}
    for i, (*_, code, message) in enumerate(CASES):
        assert (got[i].is_valid, got[i].error_code, got[i].error_msg) == (code == "", code, message), i


def test_flag_and_sql_agree_with_messages(spark, candidates):
    register_sql_functions(spark)
    rows = quality.annotate_validity(candidates).withColumns({
        "flag": quality.validity_flag(),
        "sql_flag": F.expr("review_valid(rating, text, likes)"),
        "sql_error": F.expr("review_error(rating, text, likes)")}).collect()
    for r in rows:
        assert r.flag == r.is_valid == r.sql_flag
        assert r.sql_error == r.error_msg


def test_sql_function_is_inlined(spark, candidates):
    register_sql_functions(spark)
    plan = candidates.select(F.expr("review_valid(rating, text, likes)"))._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "CASE WHEN" in plan


def test_kept_plus_rejected_is_everything(candidates):
    kept, bad = quality.keep_valid(candidates), quality.rejected(candidates, id_col="review_id")
    assert kept.columns == candidates.columns
    assert kept.count() + bad.count() == len(CASES)
    summary = quality.validation_summary(candidates).first()
    assert (summary.total, summary.valid) == (len(CASES), kept.count())
    assert summary.valid_pct + summary.invalid_pct == pytest.approx(100)


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], CANDIDATE_REVIEW)
    assert tuple(quality.validation_summary(empty).first()) == (0, 0, 0, 0.0, 0.0)


def test_breakdown_orders_counts_and_cuts(spark):
    long = "m" * 80
    df = spark.createDataFrame([(False, "a", "first")] * 2 + [(False, "b", long)] * 3 + [(True, "", "")] * 9,
                               "is_valid boolean, error_code string, error_msg string")
    assert [tuple(r) for r in quality.error_breakdown(df).collect()] == [
        ("b", "m" * 70 + "...", 3), ("a", "first", 2)]
    assert quality.error_breakdown(df, top=1).count() == 1
