"""A blocked Bloom filter in DataFrame form: which rows may have one of very many keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.session import durable

#: Fixed by Spark's bitmap functions: bits of one bitmap.
BLOCK_BITS = 32_768
#: Bitmaps of a filter: 16 MB in all, whatever the number of keys. Ten million keys let about one row in thirty through.
FILTER_BLOCKS = 4096
PROBES = 4


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _probe(key: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), key), F.lit(BLOCK_BITS)).cast("int")


def bloom_filter(keys: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """block, bits of the keys (one column, nulls included): at most `blocks` rows of 4 KB. Tasks set bits, bitmaps are merged."""
    key = F.col(keys.columns[0])
    set_bits = keys.select(_block(key, blocks).alias("block"), F.explode(F.array(*[_probe(key, i) for i in range(PROBES)])).alias("bit"))
    return durable(set_bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def split_by_filter(rows: DataFrame, key: str, bloom: DataFrame, blocks: int = FILTER_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the filter, rows whose key is not). No row is shuffled; all rows of a key are on one side."""
    def bit(i: int) -> Column:
        at = _probe(F.col(key), i)
        byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(at, 3) + 1), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1

    held = F.broadcast(bloom.withColumnsRenamed({"block": "_block", "bits": "_bits"}))
    looked = rows.join(held, _block(F.col(key), blocks) == F.col("_block"), "left")
    member = F.col("_bits").isNotNull()
    for i in range(PROBES):
        member = member & bit(i)
    member = F.coalesce(member, F.lit(False))
    return tuple(looked.filter(side).select(rows.columns) for side in (member, ~member))
