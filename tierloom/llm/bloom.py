"""Blocked Bloom filter built and probed with DataFrame operations.

The filter is a table with one row per block that is not empty: the block's number and eight words of 64
bits. A key sets one bit in each of the eight words of the single block its hash names, so probing reads
one row. The table is broadcast only if its size, which follows from the number of keys, is small enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 8
BITS_PER_KEY = 16
# Largest filter that is sent to every executor.
BROADCAST_BYTES = 64_000_000
_BLOCK = "_bloom_block"
# Blocks that rows without a key are dealt to.
SPREAD = 1 << 20


def block_count(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    """Blocks for this many distinct keys."""
    return max(1, -(-keys * bits_per_key // (64 * WORDS)))


def fits(blocks: int) -> bool:
    """True if a filter of so many blocks may be broadcast; a row takes some 200 bytes once it is hashed."""
    return blocks * 200 <= BROADCAST_BYTES


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks)).cast("long")


def _asked_block(key: Column, blocks: int) -> Column:
    """Block of a key for a join by shuffling: rows without a key ask none, and go to blocks that do not exist, evenly."""
    none = -1 - F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD))
    return F.when(key.isNotNull(), _block(key, blocks)).otherwise(none)


def _bit(key: Column, word: int) -> Column:
    """The one bit a key has in a word of its block; six bits of a second hash choose it."""
    place = F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def build(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of all keys that are not null; equal keys change nothing."""
    held = F.col(key)
    words = [F.bit_or(_bit(held, w)).alias(f"_w{w}") for w in range(WORDS)]
    return keys.where(held.isNotNull()).groupBy(_block(held, blocks).alias(_BLOCK)).agg(*words)


def probe(df: DataFrame, key: str, bloom: DataFrame, blocks: int, out: str = "maybe") -> DataFrame:
    """All rows and a flag: false if the key is certainly not among the filter's keys, or null."""
    held = F.col(key)
    hit = F.lit(True)
    for w in range(WORDS):
        bit = _bit(held, w)
        hit = hit & (F.coalesce(F.col(f"_w{w}"), F.lit(0).cast("long")).bitwiseAND(bit) == bit)
    if fits(blocks):
        joined = df.withColumn(_BLOCK, _block(held, blocks)).join(F.broadcast(bloom), _BLOCK, "left")
    else:
        joined = df.withColumn(_BLOCK, _asked_block(held, blocks)).join(bloom.hint("merge"), _BLOCK, "left")
    return joined.withColumn(out, held.isNotNull() & hit).select(*df.columns, out)
