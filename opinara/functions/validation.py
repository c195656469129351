"""Review validation rules as one expression: rating, text present, text length, likes."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the review contract: bounds and the messages readers see.
MIN_RATING = 1.0
MAX_RATING = 5.0
MAX_TEXT_CHARS = 5000
MIN_LIKES = 0
BAD_RATING = "rating must be between 1.0 and 5.0, got "
EMPTY_TEXT = "text must not be empty"
LONG_TEXT = "text too long: "
LONG_TEXT_END = " chars, max 5000"
BAD_LIKES = "likes must be >= 0, got "
NULL_FIELD = "rating, text and likes must not be null"


def _rules(rating: Column, text: Column, likes: Column) -> list[tuple[str, Column, Column]]:
    """(code, violated, message), in the order they are checked."""
    rating = rating.cast("double")
    length = F.char_length(text)
    # Bytes are stored, characters must be counted: count only where the bytes leave it open.
    too_long = (F.octet_length(text) > MAX_TEXT_CHARS) & (length > MAX_TEXT_CHARS)
    got = F.when(F.isnan(rating), "nan").otherwise(rating.cast("string"))
    return [
        ("null_field", rating.isNull() | text.isNull() | likes.isNull(), F.lit(NULL_FIELD)),
        # NaN sorts above every number, so it fails the upper bound.
        ("rating", (rating < MIN_RATING) | (rating > MAX_RATING), F.concat(F.lit(BAD_RATING), got)),
        ("empty_text", F.octet_length(text) == 0, F.lit(EMPTY_TEXT)),
        ("long_text", too_long,
         F.concat(F.lit(LONG_TEXT), length.cast("string"), F.lit(LONG_TEXT_END))),
        ("likes", likes < MIN_LIKES, F.concat(F.lit(BAD_LIKES), likes.cast("string"))),
    ]


def review_check(rating: Column, text: Column, likes: Column) -> Column:
    """struct(is_valid, error_code, error_msg) for the first broken rule; codes and text empty if valid."""
    def verdict(ok: bool, code: str, message: Column) -> Column:
        return F.struct(F.lit(ok).alias("is_valid"), F.lit(code).alias("error_code"),
                        message.alias("error_msg"))

    rules = _rules(rating, text, likes)
    code, broken, message = rules[0]
    chain = F.when(broken, verdict(False, code, message))
    for code, broken, message in rules[1:]:
        chain = chain.when(broken, verdict(False, code, message))
    return chain.otherwise(verdict(True, "", F.lit("")))


def review_is_valid(rating: Column, text: Column, likes: Column) -> Column:
    """The same rules as a plain, never-null boolean."""
    any_broken = F.lit(False)
    for _, broken, _ in _rules(rating, text, likes):
        any_broken = any_broken | F.coalesce(broken, F.lit(False))
    return ~any_broken


def register_sql_functions(spark: SparkSession) -> None:
    """Make the rules callable from SQL. Both bodies are SQL, so the optimizer inlines them."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION review_error(rating DOUBLE, body STRING, likes INT)
        RETURNS STRING
        RETURN CASE
            WHEN rating IS NULL OR body IS NULL OR likes IS NULL THEN '{NULL_FIELD}'
            WHEN rating < {MIN_RATING} OR rating > {MAX_RATING}
                THEN concat('{BAD_RATING}', if(isnan(rating), 'nan', cast(rating AS STRING)))
            WHEN octet_length(body) = 0 THEN '{EMPTY_TEXT}'
            WHEN octet_length(body) > {MAX_TEXT_CHARS} AND char_length(body) > {MAX_TEXT_CHARS}
                THEN concat('{LONG_TEXT}', char_length(body), '{LONG_TEXT_END}')
            WHEN likes < {MIN_LIKES} THEN concat('{BAD_LIKES}', likes)
            ELSE '' END""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION review_valid(rating DOUBLE, body STRING, likes INT)
        RETURNS BOOLEAN
        RETURN review_error(rating, body, likes) = ''""")
