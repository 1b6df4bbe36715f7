"""Cleaning a table before it is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierloom.functions import normalize_na, parse_timestamp, snake_case, strip_ws, to_number, typed_default

# Parts of a column name that hint at a date, and the share of values that must parse.
DATE_HINTS = ("_at", "date", "time", "timestamp", "created", "updated", "expired")
PARSED_SHARE = 0.8

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


class NullsFound(ValueError):
    """A column that must be complete holds nulls."""


def _map_columns(df: DataFrame, change: dict[str, Column]) -> DataFrame:
    if not change:
        return df
    return df.select(*[change[c].alias(c) if c in change else F.col(f"`{c}`") for c in df.columns])


def _of_type(df: DataFrame, *types: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = [snake_case(c) for c in df.columns]
    return df if names == df.columns else df.toDF(*names)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip whitespace at both ends of every text column."""
    return _map_columns(df, {c: strip_ws(F.col(c)) for c in _of_type(df, T.StringType)})


def normalize_na_tokens(df: DataFrame) -> DataFrame:
    """Words for missing values become null in every text column."""
    return _map_columns(df, {c: normalize_na(F.col(c)) for c in _of_type(df, T.StringType)})


def _as_timestamp(c: str, dtype: T.DataType, formats: Sequence[str]) -> Column | None:
    if isinstance(dtype, T.StringType):
        return parse_timestamp(F.col(c), *formats)
    if isinstance(dtype, T.IntegralType):
        # A number counts nanoseconds; flooring in whole numbers, as a double loses the last digits.
        nanos = F.col(c).cast("long")
        return F.timestamp_micros(F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000)))
    if isinstance(dtype, _TIME_TYPES):
        return F.col(c).cast("timestamp")
    return None


def datetime_evidence(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Per column whose name hints at a date: values, values that parse, and the verdict. One pass."""
    hinted = [
        (f.name, parsed)
        for f in df.schema.fields
        if any(hint in f.name.lower() for hint in DATE_HINTS)
        and (parsed := _as_timestamp(f.name, f.dataType, formats)) is not None
    ]
    if not hinted:
        return df.sparkSession.createDataFrame([], "column string, non_null long, parsed long, is_datetime boolean")
    counts = [F.struct(F.count(c).alias("non_null"), F.count(p).alias("parsed")).alias(c) for c, p in hinted]
    listed = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.non_null"), F.col(f"`{c}`.parsed")) for c, _ in hinted]
    )
    enough = (F.col("non_null") > 0) & (F.col("parsed") >= F.col("non_null") * F.lit(PARSED_SHARE).cast("double"))
    return df.agg(*counts).select(F.inline(listed)).withColumn("is_datetime", enough)


def infer_datetime_columns(df: DataFrame, formats: Sequence[str] = ()) -> list[str]:
    """Date columns by name hint and share of values that parse; declared columns save this job."""
    already = _of_type(df, *_TIME_TYPES)
    found = [r["column"] for r in datetime_evidence(df, formats).where("is_datetime").collect()]
    return [c for c in df.columns if c in already or c in found]


def cast_datetimes(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = ()) -> DataFrame:
    """Parse the columns to timestamps; what does not parse becomes null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c in columns if c in types and not isinstance(types[c], T.TimestampType)]
    parsed = {c: _as_timestamp(c, types[c], formats) for c in texts}
    return _map_columns(df, {c: p for c, p in parsed.items() if p is not None})


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a null in one of the keys the table has."""
    present = [k for k in keys if k in df.columns]
    return df.dropna(subset=present) if present else df


def coerce_numeric(df: DataFrame, columns: Sequence[str], parse=to_number) -> DataFrame:
    """Text to numbers; what is no number becomes 0."""
    return _map_columns(df, {c: F.coalesce(parse(F.col(c)), F.lit(0.0)) for c in columns if c in df.columns})


def fill_nulls_by_type(df: DataFrame) -> DataFrame:
    """Timestamps get the epoch, flags false, numbers 0 and text the empty string."""
    filled = {}
    for f in df.schema.fields:
        default = typed_default(f.dataType)
        if default is not None:
            filled[f.name] = F.coalesce(F.col(f"`{f.name}`"), default)
    return _map_columns(df, filled)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: name and number of nulls."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_count")) for c in df.columns])
    return counts.select(F.inline(rows))


def assert_no_nulls(df: DataFrame, name: str = "table") -> DataFrame:
    """Raise if any null is left. Columns the plan proves complete are not read."""
    open_columns = [f.name for f in df.schema.fields if f.nullable]
    if open_columns:
        total = null_counts(df.select(*open_columns)).agg(F.sum("null_count")).first()[0]
        if total:
            raise NullsFound(f"{name}: expected no nulls, found {total}")
    return df


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the running job at the first null in one of the columns, before a write commits."""
    checked = {
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in {c}"))).otherwise(F.col(c))
        for c in columns
        if c in df.columns
    }
    return _map_columns(df, checked)


def clean_table(
    df: DataFrame,
    keys: Sequence[str] = (),
    numeric: Sequence[str] = (),
    datetimes: Sequence[str] | None = None,
    parse_numeric=to_number,
) -> DataFrame:
    """Rename, trim, parse dates, drop rows without keys, coerce numbers, fill what is missing.

    Name the date columns in ``datetimes`` to keep the whole chain lazy; otherwise one job over the
    candidate columns finds them.
    """
    out = df.transform(snake_case_columns).transform(trim_strings).transform(normalize_na_tokens)
    dates = infer_datetime_columns(out) if datetimes is None else datetimes
    out = cast_datetimes(out, dates)
    out = require_keys(out, keys)
    out = coerce_numeric(out, numeric, parse_numeric)
    return assert_no_nulls(fill_nulls_by_type(out))
