"""Writing reports, partitioned datasets, keyed tables and layers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierloom.operators.cleaning import require_not_null
from tierloom.operators.dedupe import best_per_key
from tierloom.operators.joins import is_small
from tierloom.operators.quality import Check, run_checks
from tierloom.session import scratch_dir
from tierloom.sources.readers import scan_table


# Whether the shuffle files of an action go when it ends, and not when the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    was = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, was)


def _store(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_dir(df.sparkSession)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """The table, written below the shared folder and read back: computed once, and safe from lost executors.

    The shuffle files of the write are removed when it ends.
    """
    return _store(df)[0]


def _delete(spark: SparkSession, path: str) -> None:
    files, make = files_of(spark, path)
    files.delete(make(path), True)


def _has_shuffle(df: DataFrame) -> bool:
    return bool(re.search(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()))


def write_report_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, one part file per task.

    Text is several times as large as the stored table, so a table that shuffles is stored first: its shuffle files are
    gone when the text is written.
    """
    df, aside = _store(df) if _has_shuffle(df) else (df, None)
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    if aside:
        _delete(df.sparkSession, aside)
    return path


def write_orc(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").orc(path)
    return path


def write_partitioned_parquet(df: DataFrame, path: str, by: Sequence[str] = ("year", "month")) -> str:
    """Parquet laid out by the given columns; a rerun replaces only the partitions it holds.

    The rebalance hint brings rows of one partition together, so a task does not open a file in every
    partition, and lets AQE split a partition that is too large for one task.
    """
    missing = [c for c in by if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns not in the data: {missing}")
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return path


def publish_to_uri(df: DataFrame, bucket: str, dataset: str, by: Sequence[str] = ("year", "month")) -> str:
    """Partitioned Parquet below ``bucket/dataset``, written there directly by the executors."""
    return write_partitioned_parquet(df, f"{bucket.rstrip('/')}/{dataset}", by)


def write_profile(profile: DataFrame, path: str) -> str:
    """Column profiles of many tables, one partition per table."""
    return write_partitioned_parquet(profile, path, ["table"])


def create_table_if_absent(
    spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet", path: str | None = None
) -> None:
    """Empty table with this schema, unless a table of that name exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt, schema=schema)


def _existing(spark: SparkSession, target: str, fmt: str, schema: T.StructType) -> DataFrame | None:
    """The target, if there is one. A path is read with the schema that is stored there, so that a folder left
    empty by a first load that died is an empty table."""
    try:
        return spark.read.schema(schema).format(fmt).load(target) if "/" in target else scan_table(spark, target, fmt)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def insert_if_absent(
    batch: DataFrame,
    target: str,
    key: Sequence[str],
    first_by: Sequence[str | Column],
    fmt: str = "parquet",
    partition: str | None = None,
) -> str:
    """Append the rows whose key the target does not hold; the first row of a key in the batch wins.

    ``first_by`` says what "first" means, best with a unique column last. Columns starting with an
    underscore order rows only and are not stored. A null key fails the job before anything is
    committed. Rerunning a batch changes nothing, also after a load that died. ``partition`` names a column
    the target is laid out by and that a key never changes: then only the partitions the batch has rows for, that of
    nulls included, are read and compared, else the keys of the whole target. Two writers at once may both append a key: use a table
    format with MERGE where that can happen.
    """
    spark = batch.sparkSession
    stored = [c for c in batch.columns if not c.startswith("_")]
    fresh = best_per_key(require_not_null(batch, key), key, first_by)
    held = _existing(spark, target, fmt, fresh.select(*stored).schema)
    if held is not None:
        if partition:
            # An empty text is stored as null. Nulls are looked for apart, so that the other partitions still join by equality.
            of = F.col(f"`{partition}`")
            values = batch.select(F.when(of.cast("string") != "", of).alias(partition)).distinct()
            unknown = held.where(of.isNull()).join(F.broadcast(values.where(of.isNull())), F.lit(True), "left_semi")
            # A batch with very many partitions is joined to the target by shuffling.
            values = F.broadcast(values) if is_small(values) else values
            held = held.join(values, partition, "left_semi").unionByName(unknown)
        fresh = fresh.join(held.select(*key), list(key), "left_anti")
        stored = held.columns if "/" not in target else stored
    writer = fresh.select(*stored).write.mode("append").format(fmt)
    if partition:
        writer = writer.partitionBy(partition)
    writer.save(target) if "/" in target else writer.saveAsTable(target)
    return target


@dataclass(frozen=True)
class TransformSpec:
    """One step of a layer: named sources, a DataFrame function, a target and its checks."""

    name: str
    sources: Mapping[str, str]
    target: str
    transform: Callable[..., DataFrame]
    fmt: str = "parquet"
    partition_by: Sequence[str] = ()
    checks: Sequence[Check] = field(default_factory=tuple)
    source_formats: Mapping[str, str] = field(default_factory=dict)


class ChecksFailed(Exception):
    """A layer was not replaced, since its new rows fail checks."""


def files_of(spark: SparkSession, path: str):
    """File system of a path, and a function that makes paths of it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def recover(spark: SparkSession, target: str) -> None:
    """Put the old state of a target back if a run died between taking it away and putting the new one in place."""
    old = _old(target)
    if "/" in target:
        files, path = files_of(spark, target)
        if not files.exists(path(target)) and files.exists(path(old)):
            files.rename(path(old), path(target))
    elif not spark.catalog.tableExists(target) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {target}")


def _old(target: str) -> str:
    return f"{target.rstrip('/')}__old"


def write_aside(df: DataFrame, target: str, fmt: str, partition_by: Sequence[str] = (), rebalance: bool = True) -> str:
    """Write a table beside its target; the name it has there. What a run that died left there is replaced.

    Rows of a partition are brought together first, unless there are so few that each task may write a file for each.
    """
    aside = f"{target.rstrip('/')}__next"
    writer = (df.hint("rebalance", *partition_by) if partition_by and rebalance else df).write.mode("overwrite").format(fmt)
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(aside) if "/" in target else writer.saveAsTable(aside)
    return aside


def publish(spark: SparkSession, aside: str, target: str) -> str:
    """Put a written table in the place of its target by renaming; the old one goes last.

    At every moment either ``target`` is whole or ``recover`` makes it so. A store that renames by copying is slow here,
    and needs a table format instead.
    """
    recover(spark, target)
    old = _old(target)
    if "/" in target:
        files, path = files_of(spark, target)
        files.delete(path(old), True)
        if files.exists(path(target)) and not files.rename(path(target), path(old)):
            raise OSError(f"cannot take {target} away")
        if not files.rename(path(aside), path(target)):
            raise OSError(f"cannot put {aside} in place")
        files.delete(path(old), True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        if spark.catalog.tableExists(target):
            spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return target


def materialize_layer(spark: SparkSession, spec: TransformSpec) -> str:
    """Run the transform of a spec on its sources and replace the whole target table or path.

    A source is Parquet unless ``source_formats`` names another format. The result is written aside, checked there, and
    then takes the target's place. If a check fails the old target stays and ``ChecksFailed`` lists the failures.
    """
    inputs = {k: scan_table(spark, source, spec.source_formats.get(k, "parquet")) for k, source in spec.sources.items()}
    result = spec.transform(**inputs)
    aside = write_aside(result, spec.target, spec.fmt, spec.partition_by)
    if spec.checks:
        written = spark.read.schema(result.schema).format(spec.fmt).load(aside) if "/" in aside else spark.table(aside)
        failed = [f"{r['check']}: {r['observed']}, not {r['condition']}" for r in run_checks(written, spec.checks).where("not passed").collect()]
        if failed:
            raise ChecksFailed(f"{spec.name}: {'; '.join(failed)}")
    return publish(spark, aside, spec.target)


def check_layer(spark: SparkSession, spec: TransformSpec) -> DataFrame:
    """Results of the checks of a spec on its stored target."""
    return run_checks(scan_table(spark, spec.target, spec.fmt), spec.checks)
