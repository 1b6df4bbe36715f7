"""Sharding by rendezvous hashing.

Every shard bids for every record with a number drawn from the hash of the record's key and the shard, scaled by
the shard's weight; the best bid wins. Nothing but key, shards and weights decides, so one more shard takes
records only into itself. All of it is one expression per row.

Slots number the rows of a shard without gaps. Rows are numbered inside small buckets of a shard, and each bucket
starts where the one before it ends; only the table of bucket sizes, shards times ``BUCKETS`` rows, is brought
together, and its size does not depend on the data.

Defined results: a null text has no bytes (size 1) and the checksum of nothing, 0. Rows without a key go to one
shard. Rows with equal keys go to one shard; repeated rows have neighbouring slots. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierloom.llm.shared import store

BUCKETS = 1024
SHARDS = 16


def _bid(key: Column, shard: int, weight: float) -> Column:
    """Waiting time of an exponential clock with the shard's weight as its rate; the least wins."""
    unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(2**53)
    return F.struct((-F.log(unit) / F.lit(float(weight))).alias("bid"), F.lit(shard).alias("shard"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that wins a key; weights are positive, one per shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    bids = [_bid(text, shard, weight) for shard, weight in enumerate(weights)]
    return F.array_min(F.array(*bids))["shard"]


def with_slots(rows: DataFrame, order: Sequence[str], shard: str = "shard") -> DataFrame:
    """All columns and ``slot``: place in the shard, from 0 without gaps, the same in every run."""
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int"))
    sizes = bucketed.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy(*order)) - 1
    placed = bucketed.withColumn("_place", place).join(F.broadcast(starts), [shard, "_bucket"])
    return placed.select(*rows.columns, (F.col("_start") + F.col("_place")).alias("slot"))


def sharded(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, next_weight: float = 1.0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``size`` (bytes and 1), ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` (with one more shard)."""
    key, content = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    narrow = docs.select(
        key.alias(id_col),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, next_weight]).alias("grown_shard"),
    )
    # Written once, so that bucket sizes and places come from one reading of the texts.
    placed = with_slots(store(narrow, "sharded"), [id_col, "text_crc32", "size"])
    return placed.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
