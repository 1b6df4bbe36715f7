"""Helpers several operators share: written tables, stable row order, evenly filled chunks of text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierloom.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
# Bytes of text that one chunk gathers; a longer text is a chunk of its own.
CHUNK_BYTES = 12_000_000
CUTS = "spark.sql.files.minPartitionNum"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_file_order(df: DataFrame) -> DataFrame:
    """The table itself if it is a plain scan of files, else a written copy.

    Two passes over a scan see the same rows in the same tasks; behind a shuffle they need not. How files are cut
    depends on the number of cores unless it is set, so the present number is set for the session: then passes
    agree even if executors were lost or added in between.
    """
    spark = df.sparkSession
    if not spark.conf.get(CUTS, None):
        spark.conf.set(CUTS, str(spark.sparkContext.defaultParallelism))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = [re.sub(r"^[\s:+-]*", "", line).split(" ")[0] for line in plan.splitlines() if line.strip()]
    return df if nodes and all(n in ("Project", "Filter", "Relation") for n in nodes) else store(df, "rows")


def unused(df: DataFrame, name: str) -> str:
    """A column name like this one that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_at(docs: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """Rows of a scan whose place is in column ``at`` of another table, all columns kept."""
    at = unused(docs, name)
    return docs.withColumn(at, F.monotonically_increasing_id()).join(places.select(F.col("at").alias(at)), at, "left_semi").drop(at)


def learned_from(doc_id: Column, folds: int) -> Column:
    """True for the rows a model may learn from: crc32 of the id as text leaves a remainder; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != 0, F.lit(False))


def is_held_out(doc_id: Column, folds: int) -> Column:
    """True where that remainder is 0; a row without an id is neither learned from nor held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK_BYTES) -> Iterator[tuple[bytes, pa.Table]]:
    """Tables of consecutive rows with about ``size`` bytes of text each, named by a digest of all they hold.

    Equal rows in equal order give equal names, so two passes over the same scan agree on them.
    """
    held: list[pa.RecordBatch] = []
    weight = 0

    def named() -> tuple[bytes, pa.Table]:
        table = pa.Table.from_batches(held).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return hashlib.blake2b(sink.getvalue(), digest_size=16).digest(), table

    for batch in batches:
        start = 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        for row, length in enumerate(lengths):
            weight += length + 64
            if weight >= size:
                held.append(batch.slice(start, row + 1 - start))
                yield named()
                held, weight, start = [], 0, row + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield named()


def packed(table: pa.Table) -> bytes:
    """A table as one compressed value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes) -> pa.Table:
    with pa.ipc.open_stream(value) as reader:
        return reader.read_all()


def pack_chunks(docs: DataFrame, text: str, size: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: its name and its rows as one compressed value."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table in chunks(batches, text, size):
            yield pa.RecordBatch.from_pydict({"chunk": [name], "rows": [packed(table)]}, ROWS)

    return docs.mapInArrow(pack, "chunk binary, rows binary")


ROWS = pa.schema([("chunk", pa.binary()), ("rows", pa.binary())])
