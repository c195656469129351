"""Spark-native analytics for product reviews.

Every operator takes DataFrames and returns a DataFrame. Window sizes, "now"
(`as_of`) and thresholds are arguments, so batch results are reproducible.
"""
