"""Law of the shards, slots and checksums."""

import math
import struct
import zlib

import xxhash
from pyspark.sql import functions as F

from tierloom.llm import sharding
from tierloom.llm.shared import read


def test_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    found = sharding.sharded(docs).collect()
    assert len(found) == len(texts)
    slots = {}
    for row in found:
        text = texts[row["doc_id"]]
        assert (row["size"], row["text_crc32"], row["law"]) == (len(text) + 1, zlib.crc32(text), "key")
        assert 0 <= row["shard"] < 16 and row["grown_shard"] in (row["shard"], 16)
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r["grown_shard"] == 16 for r in found)
    assert 0 < moved < 3 * len(found) / 17


def test_key_alone_decides(rows):
    a = rows("doc_id long, text string", *[(i, "x") for i in range(100)])
    b = rows("doc_id int, text string, shard int", *[(i, "other", 3) for i in reversed(range(100))])
    shards = lambda df: {r["doc_id"]: r["shard"] for r in sharding.sharded(df).collect()}
    assert shards(a) == shards(b)


def winner(key, weights):
    """The shard by its definition: the shortest waiting time, from the hash of key and shard."""

    def wait(shard):
        first = xxhash.xxh64_intdigest(key.encode(), 42)
        unit = ((xxhash.xxh64_intdigest(struct.pack("<i", shard), first) >> 11) + 0.5) / 2**53
        return -math.log(unit) / weights[shard]

    return min(range(len(weights)), key=wait)


def test_winners_against_plain_python(rows):
    keys = [*range(-200, 400), 2**40, None]
    for weights in ((1.0,) * 16, (0.5, 3.0, 1.0, 7.0)):
        found = rows("k long", *[(k,) for k in keys]).select("k", sharding.shard_of(F.col("k"), weights).alias("s")).collect()
        assert {r["k"]: r["s"] for r in found} == {k: winner("" if k is None else str(k), weights) for k in keys}


def test_copies_of_a_whole_row(rows):
    found = sharding.sharded(rows("doc_id long, text string", *[(7, "same")] * 300, (8, "x"))).collect()
    of = [r for r in found if r["doc_id"] == 7]
    assert len({r["shard"] for r in of}) == 1 and len({r["slot"] for r in of}) == 300


def test_weights(spark):
    keys = spark.range(40_000).select(sharding.shard_of(F.col("id"), (1.0, 3.0)).alias("s"))
    share = keys.where("s = 1").count() / 40_000
    assert 0.73 < share < 0.77


def test_defined_results(rows):
    docs = rows("doc_id long, text string, _bucket int", (None, None, 1), (None, "x", 1), (1, "", 1), (1, "", 1), (1, "y" * 100_000, 1))
    found = sharding.sharded(docs).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in found) == sorted([(1, 0), (2, zlib.crc32(b"x")), (1, 0), (1, 0), (100_001, zlib.crc32(b"y" * 100_000))])
    assert len({r["shard"] for r in found if r["doc_id"] is None}) == 1
    assert len({(r["shard"], r["slot"]) for r in found}) == 5
    assert sharding.sharded(docs.limit(0)).collect() == []
