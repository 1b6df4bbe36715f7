"""Column profiles that add up: states per part of a table, stored, and merged without reading rows again.

A state holds rows, nulls, least and greatest value, an HLL sketch of the distinct values and, for numbers, a KLL sketch of
the distribution. States of parts that share no row merge to the state of the whole: counts, nulls and bounds exactly,
distinct values within about ``1.04 / sqrt(2 ** lg)``, quantiles within the rank error of the KLL sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierloom.sources.writers import write_partitioned_parquet

LG = 12
K = 400
QUARTILES = (0.25, 0.5, 0.75)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def _exact(c: Column, dtype: T.DataType) -> Column:
    """Whole numbers, decimals, flags and times as a decimal that holds them exactly; null for other types."""
    if isinstance(dtype, _TIMES):
        return F.unix_micros(c.cast("timestamp")).cast("decimal(38,10)")
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("decimal(38,10)")
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return c.cast("decimal(38,10)")
    return F.lit(None).cast("decimal(38,10)")


def _double(c: Column, dtype: T.DataType) -> Column:
    return c.cast("double") if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType) else F.lit(None).cast("double")


def profile_states(df: DataFrame, name: str, part: str | Column | None = None, lg: int = LG, k: int = K) -> DataFrame:
    """States of all columns, one row per part and column, from one pass. ``part`` says which part a row belongs to.

    Rows are merged where they are read, so a part of any size is a few rows when it is shuffled.
    """
    by = F.lit("all") if part is None else (F.col(f"`{part}`") if isinstance(part, str) else part)
    states = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        text = F.to_json(F.struct(c)) if isinstance(f.dataType, _NESTED) else c.cast("string")
        number = F.when(~F.isnan(c.cast("double")), c.cast("double")) if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")
        states.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.count("*").alias("rows"),
                F.count_if(c.isNull()).alias("nulls"),
                F.min(_exact(c, f.dataType)).alias("low"),
                F.max(_exact(c, f.dataType)).alias("high"),
                F.min(_double(c, f.dataType)).alias("low_double"),
                F.max(_double(c, f.dataType)).alias("high_double"),
                F.hll_sketch_agg(F.when(c.isNotNull(), text), F.lit(lg)).alias("distinct"),
                F.count(number).alias("numbers"),
                F.kll_sketch_agg_double(number, F.lit(k)).alias("quantiles"),
            ).alias(f"_{i}")
        )
    grouped = df.groupBy(by.cast("string").alias("part")).agg(*states)
    listed = F.inline(F.array(*[F.col(f"_{i}") for i in range(len(states))]))
    return grouped.select(F.lit(name).alias("table"), "part", listed)


def write_states(states: DataFrame, path: str) -> str:
    """Store states by table and part; those of a part that was profiled before are replaced."""
    return write_partitioned_parquet(states, path, ["table", "part"])


def merge_states(states: DataFrame) -> DataFrame:
    """One state per table and column; its part is ``all``."""
    merged = states.groupBy("table", "position", "column", "dtype").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("low_double").alias("low_double"),
        F.max("high_double").alias("high_double"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.sum("numbers").alias("numbers"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    return merged.select("table", F.lit("all").alias("part"), *[c for c in merged.columns if c != "table"])


def _shown(exact: str, double: str) -> Column:
    """Text of a bound as ``profile_table`` writes it."""
    value, kind = F.col(exact), F.col("dtype")
    time = F.date_format(F.timestamp_micros(value.cast("long")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    scale = F.coalesce(F.regexp_extract("dtype", r",(\d+)\)", 1).try_cast("int"), F.lit(0))
    # A decimal keeps the digits its type has.
    decimal = F.when(scale == 0, value.cast("decimal(38,0)").cast("string")).otherwise(F.expr(f"substring(cast({exact} as string), 1, length(cast({exact} as string)) - 10 + {_SCALE})"))
    return (
        F.when(kind.isin("timestamp", "timestamp_ntz", "date"), time)
        .when(kind == "boolean", (value == 1).cast("string"))
        .when(kind.startswith("decimal"), decimal)
        .when(kind.isin("double", "float"), F.col(double).cast("string"))
        .otherwise(value.cast("long").cast("string"))
    )


_SCALE = r"int(regexp_extract(dtype, ',([0-9]+)[)]', 1))"


def profile_of(states: DataFrame) -> DataFrame:
    """Profiles from states: rows, nulls, distinct values (estimate), bounds and quartiles (estimates)."""
    quartiles = F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double(F.col("quantiles"), F.array(*[F.lit(q) for q in QUARTILES])))
    return states.select(
        "table",
        "part",
        "column",
        "dtype",
        "rows",
        F.col("nulls").alias("null_count"),
        F.hll_sketch_estimate("distinct").alias("distinct_count"),
        _shown("low", "low_double").alias("min"),
        _shown("high", "high_double").alias("max"),
        quartiles.alias("quartiles"),
    )
