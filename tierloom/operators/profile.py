"""Column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierloom.operators.cleaning import _as_timestamp, infer_datetime_columns

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _text(c: Column, dtype: T.DataType) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if isinstance(dtype, _TIMES) else c.cast("string")


def _digest(c: Column) -> Column:
    """128 bits of a value; null for null."""
    return F.unhex(F.md5(c.cast("string").cast("binary")))


def profile_table(
    df: DataFrame, name: str, approximate: bool = False, infer_dates: bool = False, dates: Sequence[str] = ()
) -> DataFrame:
    """Per column: type, nulls, distinct values, and min and max of numbers, flags and dates.

    Exact distinct counts go over (column, digest of the value) pairs: a task first merges its equal pairs,
    so a value that fills a third of a column is shuffled once per task, and long texts travel as 16 bytes.
    ``approximate`` keeps everything in one pass with sketches and shuffles no values. ``dates`` names text
    columns that hold dates and so have min and max; ``infer_dates`` finds them, at the price of one more pass.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    as_dates = set(infer_datetime_columns(df)) | set(dates) if infer_dates else set(dates)

    measured = {}
    for c, dtype in fields.items():
        if isinstance(dtype, T.NumericType):
            measured[c] = (F.col(f"`{c}`"), dtype)
        elif isinstance(dtype, T.BooleanType):
            measured[c] = (F.col(f"`{c}`"), dtype)
        elif isinstance(dtype, _TIMES):
            measured[c] = (F.col(f"`{c}`").cast("timestamp"), T.TimestampType())
        elif c in as_dates:
            measured[c] = (_as_timestamp(c, dtype, ()), T.TimestampType())

    def bound(c: str, function) -> Column:
        return F.lit(None).cast("string") if c not in measured else _text(function(measured[c][0]), measured[c][1])

    stats = [
        F.struct(
            F.lit(i).alias("_position"),
            F.lit(c).alias("column"),
            F.lit(dtype.simpleString()).alias("dtype"),
            F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"),
            (F.approx_count_distinct(F.col(f"`{c}`")) if approximate else F.lit(None).cast("long")).alias("distinct_count"),
            bound(c, F.min).alias("min"),
            bound(c, F.max).alias("max"),
        ).alias(f"_{i}")
        for i, (c, dtype) in enumerate(fields.items())
    ]
    rows = df.agg(*stats).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(stats))])))
    if not approximate:
        pairs = F.explode(
            F.array(
                *[F.struct(F.lit(i).alias("p"), _digest(F.col(f"`{c}`")).alias("v")) for i, c in enumerate(fields)]
            )
        )
        values = df.select(pairs.alias("pair")).select("pair.p", "pair.v").where(F.col("v").isNotNull()).distinct()
        counts = values.groupBy("p").agg(F.count("*").alias("_distinct"))
        rows = rows.join(counts, rows["_position"] == counts["p"], "left").withColumn(
            "distinct_count", F.coalesce("_distinct", F.lit(0).cast("long"))
        )
    return rows.select(F.lit(name).alias("table"), "column", "dtype", "null_count", "distinct_count", "min", "max")


def profile_tables(tables: Mapping[str, DataFrame], **options) -> DataFrame:
    """Profiles of many tables as one long table."""
    profiles = [profile_table(df, name, **options) for name, df in tables.items()]
    out = profiles[0]
    for profile in profiles[1:]:
        out = out.unionByName(profile)
    return out
