"""A bitmap of hashes that goes to all tasks, so that most rows without a partner leave before a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.llm.texts import free_name

#: Bits of the bitmap: 2 MB, whatever the tables' sizes.
FILTER_BITS = 1 << 24


def perhaps_in(df: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` (a hash) is in ``wanted``, and a few others.

    A full bitmap lets more rows pass, never fewer; an exact join follows.
    """
    bit = lambda name: F.pmod(F.col(name), F.lit(FILTER_BITS))
    marked = wanted.select(bit(column).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("__bucket"))
    bitmap = marked.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("__bitmap"))
    at = F.bitmap_bit_position(bit(column))
    byte = F.conv(F.hex(F.substring("__bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = df.withColumn("__bucket", F.bitmap_bucket_number(bit(column))).join(F.broadcast(bitmap), "__bucket")
    return near.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("__bucket", "__bitmap")


def perhaps(df: DataFrame, wanted: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with a boolean column: false only if ``column`` (a hash) isn't in ``wanted``.

    A bitmap in words of 64 bits, which is quicker to look up than ``perhaps_in``. A full one says
    true more often, never less, so an exact join follows.
    """
    at, held = free_name(df.columns, "__word"), free_name(df.columns, "__mask")
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS))
    word, mask = F.shiftright(bit, 6).alias(at), F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 64L) as int))")
    words = wanted.select(word, mask.alias("mask")).groupBy(at).agg(F.bit_or("mask").alias(held))
    near = df.withColumn(at, word).join(F.broadcast(words), at, "left")
    return near.withColumn(name, F.coalesce(F.col(held).bitwiseAND(mask) != 0, F.lit(False))).drop(at, held)


def parted(df: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` may be in the column ``wanted.key``, and those whose key isn't."""
    hashed, there = free_name(df.columns, "__hash"), free_name(df.columns, "__there")
    marked = df.withColumn(hashed, F.xxhash64(key))
    marked = perhaps(marked, wanted.select(F.xxhash64("key").alias(hashed)), hashed, there)
    return marked.where(there).select(*df.columns), marked.where(~F.col(there)).select(*df.columns)
