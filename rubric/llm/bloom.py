"""Blocked Bloom filters as tables (native).

A key sets one bit in each of eight 32-bit words of one block; a filter is one row a
block, so it is built by a hash aggregate and asked by an equi-join on the block.  It
has at most ``MAX_BLOCKS`` rows of nine integers, whatever the number of keys, so its
broadcast is bounded; more keys only raise the share of false hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At least 16 bits a key, in 256-bit blocks, up to the bound.
BITS_PER_KEY = 16
BLOCK_BITS = 256
MAX_BLOCKS = 1 << 16
WORDS = 8


def n_blocks_for(n_keys: int) -> int:
    need = max(1, -(-n_keys * BITS_PER_KEY // BLOCK_BITS))
    return min(MAX_BLOCKS, 1 << (need - 1).bit_length())


def block_of(key: Column, n_blocks: int) -> Column:
    """The block of a 64-bit hash."""
    return F.pmod(F.shiftrightunsigned(key, 32), F.lit(n_blocks)).cast("int")


def word_masks(key: Column) -> list[Column]:
    """One bit in each word of the block: five bits of a second hash each."""
    bits = F.xxhash64(key)
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(bits, 5 * k).bitwiseAND(F.lit(31)).cast("int"))
            for k in range(WORDS)]


def blocks(keys: DataFrame, n_blocks: int) -> DataFrame:
    """The filter of ``keys`` (key): block, w0..w7; at most ``n_blocks`` rows."""
    masks = [m.alias(f"w{k}") for k, m in enumerate(word_masks(F.col("key")))]
    return keys.select(block_of(F.col("key"), n_blocks).alias("block"), *masks).groupBy("block").agg(
        *[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])


def all_bits(key: Column) -> Column:
    """Whether a key's bits are all set in the block that it was joined with."""
    hit = F.lit(True)
    for k, mask in enumerate(word_masks(key)):
        hit = hit & (F.col(f"w{k}").bitwiseAND(mask) != 0)
    return hit


def flag(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false only for rows whose ``key`` is none of ``keys``
    (key).  No row is shuffled."""
    n = n_blocks_for(keys.count())
    asked = rows.withColumn("__key", key).withColumn("block", block_of(F.col("__key"), n))
    held = F.broadcast(blocks(keys, n))   # at most MAX_BLOCKS rows of nine integers
    return asked.join(held, "block", "left").select(*rows.columns, F.coalesce(all_bits(F.col("__key")), F.lit(False)).alias("maybe"))
