"""Training-data pipeline: documents in, token ids out. Each stage reads what the stage before it wrote.

An empty table stays empty through all stages. Extra columns are kept up to the mix, whatever they are called.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierloom.llm import bpe, exact_dedup, langid, mixing, near_dedup
from tierloom.llm.queries import WORD_TOKENIZER
from tierloom.llm.shared import read, store
from tierloom.session import BATCH_BYTES, RUNTIME_CONF, configure


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches that Python workers get, also where a stage runs by itself in a session not configured here."""
    spark.conf.set(BATCH_BYTES, RUNTIME_CONF[BATCH_BYTES])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.

    A null text, or one without a letter, has none and goes. Repeated rows are judged alike. Extra columns stay.
    """
    small_batches(spark)
    return langid.keep_identified(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text: the least doc_id, a null one last; of equal rows one stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8 or more.

    The least doc_id stays, a null one last. A text without words is like no other and stays.
    """
    small_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken more than once is that many rows.

    A document without words has size 0 and is not taken. A null source is a source of its own, the last one.
    """
    small_batches(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of the ids and of the text decoded from them; one row per row, nulls and repeats included."""
    small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path(WORD_TOKENIZER), keep=("doc_id", "source", "lang"), digests=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's result written to the shared folder and read again."""
    docs = read(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
