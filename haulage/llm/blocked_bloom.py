"""Blocked Bloom filter as DataFrame columns: one 64-bit word per block, so a probe reads one word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def mask_of(key: Column) -> Column:
    """The bits of a key within its block, from a second hash."""
    def bits(h):
        out = F.lit(0).cast("long")
        for i in range(PROBES):
            bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
            out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        return out
    return once(F.xxhash64(key, F.lit("bits")), bits)


def once(value: Column, fn) -> Column:
    """``fn(value)`` with the value worked out once, however often fn uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def words_of_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row with the filter as an array of ``blocks`` words.

    The words of a block are combined map-side (bit_or), so what reaches the
    last task is at most ``blocks`` rows, however many keys there are.
    """
    spark = keys.sparkSession
    zero = spark.range(blocks).select(F.col("id").cast("int").alias("b"), F.lit(0).cast("long").alias("w"))
    words = (keys.where(F.col(key).isNotNull())
             .select(block_of(F.col(key), blocks).alias("b"), mask_of(F.col(key)).alias("w"))
             .unionByName(zero).groupBy("b").agg(F.bit_or("w").alias("w")))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "w"))), lambda x: x["w"]).alias("words"))


def may_hold(key: Column, keys: DataFrame, key_col: str, blocks: int) -> Column:
    """True for every row whose key is among ``keys`` and for a few others; false for a null key.

    The array that each task gets has ``blocks`` words of 8 bytes.
    """
    at = once(key, lambda k: F.when(k.isNotNull(), F.struct(block_of(k, blocks).alias("block"), mask_of(k).alias("mask"))))
    word = F.element_at(words_of_filter(keys, key_col, blocks).scalar(), F.coalesce(at["block"], F.lit(0)) + 1)
    # no bit of the mask is missing from the word
    return F.coalesce(F.bitwise_not(word).bitwiseAND(at["mask"]) == 0, F.lit(False))
