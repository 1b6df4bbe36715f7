"""Loads that read only files no earlier run has read.

A folder of CSV files is a file stream. A run takes what is there, in batches, and ends. Which files a batch holds is
written to the state folder before the batch is read, and that it is done after it is written; so a run that dies is
followed by one that repeats its last batch with the same files and goes on. What batches do is therefore made to be
repeated: keyed rows are inserted if absent, other rows replace those of the same batch number.

Land files by renaming them into the folder. A file that changes after it was read is not read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierloom.functions import normalize_na
from tierloom.functions.strings import NA_AT_READ
from tierloom.plans.emails import DATASET_CONTRACT, EMAIL_COLUMNS, TABLE_CONTRACT, prepare_for_dataset, prepare_for_table
from tierloom.sources.readers import FILE_ORDER, gate_input_exists
from tierloom.sources.writers import create_table_if_absent, files_of, insert_if_absent, publish_to_uri

LOAD = "load"


@dataclass(frozen=True)
class Batch:
    """What one batch of a run read."""

    number: int
    rows: int


def state_dir(spark: SparkSession, name: str) -> str:
    """Folder for the state of a load below ``spark.checkpoint.dir``: the same one in every run."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir, or name a state folder that outlives the run")
    return f"{base.rstrip('/')}/loads/{name}"


def load_new_files(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    write: Callable[[DataFrame, int], None],
    state: str,
    *,
    multi_line: bool,
    files_per_batch: int | None = None,
    na_tokens: tuple[str, ...] = NA_AT_READ,
) -> list[Batch]:
    """Give the rows of new CSV files to ``write(rows, batch number)``, and say what each batch read.

    Rows have the columns as text, words for missing values as null, and ``FILE_ORDER``, which sorts them as they stand in
    the files. A file whose header is not ``columns`` fails the run, which then repeats that batch until the file is
    mended or taken away. ``files_per_batch`` bounds a batch; without it a run is one batch.
    """
    gate_input_exists(spark, folder)
    reader = spark.readStream.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    options = {"header": True, "escape": '"', "multiLine": multi_line, "enforceSchema": False, "maxFileAge": "36500d"}
    if files_per_batch:
        options["maxFilesPerTrigger"] = files_per_batch
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    lines = reader.options(**options).csv(folder).select("*", *place)

    def handle(rows: DataFrame, number: int) -> None:
        order = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))
        write(rows.select(*[normalize_na(F.col(f"`{c}`"), na_tokens).alias(c) for c in columns], order.alias(FILE_ORDER)), number)

    run = lines.writeStream.foreachBatch(handle).option("checkpointLocation", state).trigger(availableNow=True).start()
    try:
        run.awaitTermination()
    finally:
        run.stop()
    return [Batch(p["batchId"], p["numInputRows"]) for p in run.recentProgress if p["numInputRows"]]


def load_emails_table(spark: SparkSession, folder: str, target: str, state: str, *, multi_line: bool, files_per_batch: int | None = None) -> list[Batch]:
    """New email files to the keyed table: contract, clean, insert if absent. A thread stays as the first load had it."""
    if "/" not in target:
        create_table_if_absent(spark, target, TABLE_CONTRACT.struct())

    def write(rows: DataFrame, number: int) -> None:
        insert_if_absent(prepare_for_table(rows), target, TABLE_CONTRACT.primary_key, [FILE_ORDER])

    return load_new_files(spark, folder, EMAIL_COLUMNS, write, state, multi_line=multi_line, files_per_batch=files_per_batch)


def load_emails_partitioned(spark: SparkSession, folder: str, bucket: str, state: str, *, multi_line: bool, files_per_batch: int | None = None) -> list[Batch]:
    """New email files to Parquet by year, month and ``load``, the number of the batch, below ``bucket``.

    A repeated batch replaces its own partitions only. Batch numbers belong to a state, so a new state is refused for a
    dataset that holds loads of another one.
    """
    target = f"{bucket.rstrip('/')}/{DATASET_CONTRACT.name}"
    files, path = files_of(spark, target)
    states, state_path = files_of(spark, state)
    if files.exists(path(target)) and not states.exists(state_path(state)):
        raise ValueError(f"{target} holds loads that {state} does not know of")

    def write(rows: DataFrame, number: int) -> None:
        ready = prepare_for_dataset(rows.drop(FILE_ORDER)).withColumn(LOAD, F.lit(number))
        publish_to_uri(ready, bucket, DATASET_CONTRACT.name, ("year", "month", LOAD))

    return load_new_files(spark, folder, EMAIL_COLUMNS, write, state, multi_line=multi_line, files_per_batch=files_per_batch)
