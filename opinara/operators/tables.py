"""Table maintenance: keep-last upsert, dedup, retention, comparison of two results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.membership import FILTER_BLOCKS, bloom_filter, split_by_filter
from opinara.operators.scaling import few_or_shuffled
from opinara.operators.spacing import keep_spaced
from opinara.session import durable

WINDOW_KEY = ("product_id", "window_start")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` per key.

    An aggregate, not a window: copies of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def merge_latest(existing: DataFrame, batch: DataFrame, order: Sequence[str],
                 keys: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """Existing rows and a batch, last version per key. Also applied to the very first batch."""
    return keep_last(existing.unionByName(batch), keys, order)


def split_repeated(reviews: DataFrame, key: str = "id", blocks: int = FILTER_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(rows whose key occurs once, the other rows), from a pass over the keys alone.

    The keys that occur more than once go into a Bloom filter of fixed size. Rows that it does not know need no shuffle,
    so their text is never moved. A few single rows may be among the others; all rows of a key are on one side.
    """
    repeated = reviews.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    copies, single = split_by_filter(reviews, key, bloom_filter(repeated, blocks), blocks)
    return single, copies


def dedup_reviews(reviews: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """First arrival per review id, over all time."""
    single, copies = split_repeated(reviews, "id", blocks)
    return single.unionByName(keep_first(copies, ["id"], ["arrival_ts", "seq"]))


def dedup_within(reviews: DataFrame, horizon_s: int = 120, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Drop a review whose id was accepted less than `horizon_s` earlier.

    Dropped copies do not extend the horizon, so an id that is used again
    later counts as a new review.
    """
    single, copies = split_repeated(reviews, "id", blocks)
    return single.unionByName(first_within(copies, horizon_s))


def first_within(reviews: DataFrame, horizon_s: int) -> DataFrame:
    """The rule of `dedup_within` alone, for rows without text or whose ids mostly repeat: all of them are shuffled.

    An id whose reviews all arrived within the horizon keeps its first one, which an aggregate finds; only others are spaced.
    """
    dated = reviews.filter("arrival_ts is not null")
    firsts = durable(dated.groupBy("id").agg(
        F.min_by(F.struct(*reviews.columns), F.struct("arrival_ts", "seq")).alias("row"),
        (F.unix_micros(F.max("arrival_ts")) - F.unix_micros(F.min("arrival_ts")) >= horizon_s * 1_000_000).alias("wide")))
    single = firsts.filter("not wide").select("row.*")
    wide = firsts.filter("wide").select(F.col("id").alias("_id"))
    if wide.isEmpty():
        return single
    spread = dated.join(few_or_shuffled(wide), F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    kept = durable(keep_spaced(spread, "id", "arrival_ts", horizon_s).withColumnsRenamed({"id": "_id", "arrival_ts": "_at"}))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("arrival_ts") == F.col("_at"))
    at_once = spread.join(few_or_shuffled(kept), same, "left_semi")
    return single.unionByName(keep_first(at_once, ["id", "arrival_ts"], ["seq"]))


def mark_updates(batch: DataFrame, existing: DataFrame, keys: Sequence[str] = ("window_start",),
                 corrects: str | None = None) -> DataFrame:
    """Set is_update where the window was already published. Only distinct keys of `existing` are joined.

    `corrects` names a boolean column that is dropped after use: rows where it
    is false (windows still filling up) are never updates.
    """
    known = existing.select(*keys).distinct().withColumn("_known", F.lit(True))
    flag = F.col("_known").isNotNull()
    if corrects is not None:
        flag = flag & F.col(corrects)
    marked = batch.drop("is_update").join(known, list(keys), "left").withColumn("is_update", flag)
    return marked.drop("_known", *([corrects] if corrects else []))


def retain_last(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The `n` newest rows, oldest first, as a bounded store keeps them."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def retain_last_emitted(emissions: DataFrame, n: int, order: Sequence[str] = ("emitted_at", "seq")) -> DataFrame:
    """The `n` emissions that arrived last, with their position in the store (1 for the oldest kept).

    The position is a window over the n rows that are left, not over the input.
    """
    kept = emissions.orderBy(*[F.desc(c) for c in order]).limit(n)
    return kept.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def retain_since(df: DataFrame, as_of: datetime | str, max_age_s: int, ts: str = "window_start") -> DataFrame:
    """Rows not older than `max_age_s` at `as_of`. A plain comparison, so it reaches the file scan."""
    oldest = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(max_age_s))
    return df.filter(F.col(ts) >= oldest)


#: Rows are told apart by so many 64-bit hashes, summed as whole numbers.
ROW_HASHES = 4
#: Where two results differ, they are compared row by row in those of so many ranges of the hash that differ.
HASH_RANGES = 4096


def row_hashes(df: DataFrame) -> list[Column]:
    """Hashes of a whole row. Absent values are marked, since the hash function itself steps over them."""
    absent = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns])
    return [F.xxhash64(F.lit(i), absent, *df.columns) for i in range(ROW_HASHES)]


def multiset_hash(df: DataFrame, *by: Column) -> DataFrame:
    """Number of rows and sums of their hashes, over all rows or by a column. Order does not matter, multiplicity does."""
    return df.groupBy(*by).agg(F.count("*").alias("n"),
                               *[F.sum(h.cast("decimal(20,0)")).alias(f"h{i}") for i, h in enumerate(row_hashes(df))])


def hash_range(df: DataFrame) -> Column:
    return F.shiftrightunsigned(row_hashes(df)[0], 64 - HASH_RANGES.bit_length() + 1).cast("int")


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row telling whether two results hold the same rows with the same multiplicity, and how many are in one only.

    First both are summed up to one multiset hash each; a task sends one row. Only if these differ are rows shuffled:
    those whose hash lies in a range where the two sums differ, and so the counts are exact.
    """
    right = right.select(left.columns)
    # Types must agree as in a union, or equal values would hash differently.
    types = left.limit(0).unionByName(right.limit(0)).schema
    left, right = (df.select(*[F.col(f.name).cast(f.dataType) for f in types.fields]) for df in (left, right))
    spark = left.sparkSession
    result = "only_left long, only_right long, equal boolean"
    if multiset_hash(left).first() == multiset_hash(right).first():
        return spark.createDataFrame([(0, 0, True)], result)
    ranges = [multiset_hash(df, hash_range(df).alias("range")) for df in (left, right)]
    differ = [r[0] for r in ranges[0].unionByName(ranges[1]).groupBy(*ranges[0].columns).agg(F.count("*").alias("sides"))
              .filter("sides = 1").select("range").distinct().collect()]
    signed = [df.filter(hash_range(df).isin(differ)).withColumn("_sign", F.lit(sign).cast("long")) for df, sign in ((left, 1), (right, -1))]
    balance = signed[0].unionByName(signed[1]).groupBy(*left.columns).agg(F.sum("_sign").alias("_balance"))
    zero = F.lit(0).cast("long")
    return (balance.agg(F.coalesce(F.sum(F.greatest("_balance", zero)), zero).alias("only_left"),
                        F.coalesce(F.sum(F.greatest(-F.col("_balance"), zero)), zero).alias("only_right"))
            .withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0)))
