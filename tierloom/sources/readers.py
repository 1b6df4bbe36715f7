"""Reading CSV, Parquet, ORC and catalog tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierloom.functions import normalize_na, parse_timestamp, to_number
from tierloom.functions.strings import NA_AT_READ

FILE_ORDER = "_file_order"


class InputMissing(Exception):
    """The input a job was told to read is not there."""


def gate_input_exists(spark: SparkSession, path: str) -> None:
    """Stop before any work if the input is missing. Works for every URI Spark can list."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise InputMissing(f"input not found: {path}") from error
        raise


def _typed(name: str, dtype: T.DataType):
    text = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return parse_timestamp(text).cast(dtype).alias(name)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return to_number(text).cast(dtype).alias(name)
    return text.try_cast(dtype).alias(name)


def headers(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Files by their first line. Reads the lines of all files once; one line per file reaches the driver."""
    first = F.col("_metadata.file_block_start") == 0
    lines = spark.read.text(path).where(first).select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    found: dict[str, list[str]] = {}
    for file, line in lines.groupBy("file").agg(F.min_by("value", "at")).collect():
        found.setdefault(line, []).append(file)
    return found


def _raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    """All columns as text. A file whose header differs from the first file's fails the job, naming the file."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    return reader.option("enforceSchema", False).schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    *,
    na_tokens: tuple[str, ...] = NA_AT_READ,
    multi_line: bool = False,
    file_order: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """CSV with a header; words for missing values become null.

    Types come from ``schema`` (by column name), never from the data; without one all columns are text.
    ``multi_line`` allows line breaks inside quotes, but then a file cannot be split, so land large
    inputs as many files. ``file_order`` adds a column that sorts rows as they stand in the files.

    All files need the same header, else the job fails and names a file that differs. With ``by_name``
    files may order their columns as they like, each is read by its own header; that looks at the first
    line of every file first, and a file with other columns stops the scan with its path.
    """
    if by_name:
        parts = {line: _raw_csv(spark, files, multi_line) for line, files in sorted(headers(spark, path).items())}
        if not parts:
            return scan_csv(spark, path, schema, na_tokens=na_tokens, multi_line=multi_line, file_order=file_order)
        names = schema.names if schema else next(iter(parts.values())).columns
        for line, part in parts.items():
            if set(names) - set(part.columns) or (not schema and set(part.columns) - set(names)):
                raise ValueError(f"expected columns {names}, found {part.columns} in {part.inputFiles()[:5]}")
        options = {"na_tokens": na_tokens, "file_order": file_order}
        scans = [_scan(part, schema, names, **options) for part in parts.values()]
        return reduce(DataFrame.unionByName, scans)
    raw = _raw_csv(spark, path, multi_line)
    return _scan(raw, schema, schema.names if schema else raw.columns, na_tokens, file_order)


def _scan(raw: DataFrame, schema: T.StructType | None, names: list[str], na_tokens: tuple[str, ...], file_order: bool) -> DataFrame:
    wanted = [(f.name, f.dataType) for f in schema.fields] if schema else [(c, T.StringType()) for c in names]
    order = []
    if file_order:
        # Inside one block rows are numbered as read, so the triple follows the file.
        order = [
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias(FILE_ORDER)
        ]
    text = raw.select(*[normalize_na(F.col(f"`{n}`"), na_tokens).alias(n) for n, _ in wanted], *order)
    return text.select(*[_typed(n, t) for n, t in wanted], *([FILE_ORDER] if file_order else []))


def scan_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """Bronze or silver table: a catalog name such as ``silver.contacts``, or a path with a slash."""
    return spark.read.format(fmt).load(source) if "/" in source else spark.table(source)
