"""Bitmaps of key hashes with a fixed size, to spare rows without a partner the way through a join's shuffle.

A bitmap only filters: rows that pass it still meet their join. The fuller it is the more pass, which costs time only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 MB in a broadcast join, whatever the number of keys; SQL functions only.
BITS = 1 << 24


def _place(key: Column) -> Column:
    return F.pmod(key, F.lit(BITS)) + 1


def split_by_keys(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose hash ``key`` (long) may be in the column ``key`` of ``keys``, and rows whose hash surely isn't."""
    at = _place(F.col(key))
    bitmap = keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits"))
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    has = F.coalesce(byte, F.lit(0)).bitwiseAND(F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int"))) != 0
    found = rows.withColumn("_bucket", F.bitmap_bucket_number(at)).join(F.broadcast(bitmap), "_bucket", "left").withColumn("_seen", has)
    drop = ["_bucket", "_bits", "_seen"]
    return found.where("_seen").drop(*drop), found.where("not _seen").drop(*drop)
