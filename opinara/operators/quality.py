"""Validation and cleaning of incoming reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import review_check, review_is_valid, shorten


def annotate_validity(reviews: DataFrame, rating: str = "rating", text: str = "text",
                      likes: str = "likes") -> DataFrame:
    """Add is_valid, error_code and error_msg (first broken rule)."""
    return (reviews.withColumn("_check", review_check(F.col(rating), F.col(text), F.col(likes)))
            .withColumns({c: F.col(f"_check.{c}") for c in ("is_valid", "error_code", "error_msg")})
            .drop("_check"))


def validity_flag(rating: str = "rating", text: str = "text", likes: str = "likes") -> Column:
    return review_is_valid(F.col(rating), F.col(text), F.col(likes))


def keep_valid(reviews: DataFrame, **columns: str) -> DataFrame:
    return reviews.filter(validity_flag(**columns))


def rejected(reviews: DataFrame, id_col: str = "id", rating: str = "rating", text: str = "text",
             likes: str = "likes") -> DataFrame:
    """Invalid rows with the reason, for a quarantine table."""
    return (annotate_validity(reviews, rating, text, likes).filter(~F.col("is_valid"))
            .select(F.col(id_col).alias("review_id"), "product_id", F.col(rating).alias("rating"),
                    F.col(likes).alias("likes"), "is_valid", "error_msg"))


def validation_summary(reviews: DataFrame, **columns: str) -> DataFrame:
    return (reviews.select(validity_flag(**columns).alias("ok"))
            .agg(F.count("*").alias("total"), F.count_if("ok").alias("valid"),
                 F.count_if(~F.col("ok")).alias("invalid"))
            .withColumns({f"{c}_pct": F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("total")), F.lit(0.0))
                          for c in ("valid", "invalid")}))


def error_breakdown(annotated: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent error messages; long ones are cut for display, after counting."""
    return (annotated.filter(~F.col("is_valid")).groupBy("error_code", "error_msg")
            .agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "error_msg").limit(top)
            .select("error_code", shorten(F.col("error_msg"), 70).alias("error_msg"), "n"))
