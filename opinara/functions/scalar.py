"""Column helpers. All of them are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int = 2) -> Column:
    """Round half away from zero after scaling, so 1.005 gives 1.0 (its double is below the tie)."""
    scale = float(10 ** digits)
    return F.round(value * scale) / scale


def half_even(value: Column, digits: int = 2) -> Column:
    """Round half to even after scaling."""
    scale = float(10 ** digits)
    return F.rint(value * scale) / scale


def exact_mean(value: Column, digits: int) -> Column:
    """Mean of a column already rounded to `digits` decimals.

    Sums whole units, so the result does not depend on how rows were
    partitioned; null values are left out and an empty input gives null.
    """
    scale = 10 ** digits
    units = F.sum(F.rint(value * float(scale)).cast("long")).cast("double")
    return F.try_divide(units, F.count(value)) / float(scale)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def pct_change(before: Column, after: Column) -> Column:
    """(after - before) / before in percent; null if either is missing or `before` is 0."""
    return F.try_divide(after - before, before) * 100.0


def fixed_text(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", half_even(value, digits))


def percent_text(share: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f%%", half_even(share * 100.0, digits))


def shorten(text: Column, limit: int) -> Column:
    """Cut after `limit` characters and mark the cut with three dots."""
    return F.when(F.char_length(text) > limit,
                  F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def strip_prefix(key: Column, prefix: str) -> Column:
    """What follows `prefix`; empty if the key does not start with it."""
    return F.when(key.startswith(prefix), F.substring(key, len(prefix) + 1, 2**31 - 1)).otherwise("")


def rating_band(rating: Column) -> Column:
    return F.when(rating >= 4, "green").when(rating >= 3, "yellow").otherwise("red")


def parse_instant(text: Column) -> Column:
    """Timestamp from text: a number is nanoseconds since 1970, anything else ISO 8601.

    Unreadable text gives null. Text without a zone is read in the session zone (UTC).
    """
    micros = F.floor(text.try_cast("decimal(38,6)") / 1000).cast("long")
    return F.coalesce(F.timestamp_micros(micros), F.try_to_timestamp(text))


def to_epoch_ns(ts: Column) -> Column:
    return F.unix_micros(ts) * 1000
