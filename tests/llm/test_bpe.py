"""Encoding and decoding against the tokenizer library, text by text."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    (None, None), (1, ""), (2, " \t\r\n "), (3, "<|endoftext|>a b<|startoftext|>  x"), (4, "Ünï cöde\u00a0é Σας 12's don't ...!! z\x1cq"),
    (4, "same same same"), (4, "same same same"), (5, "a" * 5000), (6, "word " * 60_000), (7, "e\u0301 \u0301x 你好 \U0001f600\u200d"),
]


def expected(text):
    tokenizer = Tokenizer.from_file(PATH)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_ids_and_texts(rows):
    docs = rows("doc_id long, text string, ids string, chunk int", *[(i, t, "x", 1) for i, t in TEXTS])
    coded = bpe.decode(bpe.encode(docs, PATH, keep=("doc_id", "text")), PATH).collect()
    assert len(coded) == len(TEXTS)
    for row in coded:
        assert (row["ids"], row["decoded"]) == expected(row["text"])


def test_digests(rows):
    docs = rows("doc_id long, text string", *TEXTS)
    found = sorted((str(r[0]), *r[1:]) for r in bpe.encoded_digests(docs, PATH).collect())
    wanted = []
    for key, text in TEXTS:
        ids, decoded = expected(text)
        wanted.append((str(key), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert found == sorted(wanted)


def test_empty_table(rows):
    docs = rows("doc_id long, text string", (1, "a")).limit(0)
    assert bpe.encoded_digests(docs, PATH).collect() == []


def test_small_chunks_give_the_same(rows, spark, monkeypatch, tmp_path):
    from tierloom.llm import shared

    docs = rows("doc_id long, text string", *[(i, f"word{i % 7} and {i} " * 9) for i in range(300)])
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    whole = sorted(bpe.encoded_digests(docs, PATH).collect())
    monkeypatch.setattr(shared.chunks, "__defaults__", (500,))
    monkeypatch.setattr(shared.pack_chunks, "__defaults__", (500,))
    assert sorted(bpe.encoded_digests(docs, PATH).collect()) == whole


def test_other_decoders_are_refused(rows):
    with pytest.raises(ValueError):
        bpe.decode(rows("ids array<int>", ([1],)), public_tokenizers.path("byte_bpe_50k.json"))


def test_rows_of_a_chunk_do_not_grow_with_the_cluster(spark, rows, monkeypatch):
    """However many shuffle partitions there are, a chunk with very many words sends at most one row per bucket."""
    words = [f"w{i}x" for i in range(60_000)]
    assert sum(bool(w) for w in bpe._sent_words([" ".join(words).encode()], bpe.BUCKETS)) == bpe.BUCKETS < 1000
    docs, before = rows("doc_id long, text string", (1, " ".join(words[:500])), (2, "w1x")), spark.conf.get("spark.sql.shuffle.partitions")
    few = sorted(map(tuple, bpe.encode(docs, PATH).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "600")
    try:
        assert sorted(map(tuple, bpe.encode(docs, PATH).collect())) == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
