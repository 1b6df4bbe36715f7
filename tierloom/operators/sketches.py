"""Comparing layers through sketches: nothing is joined or shuffled by key, and what is kept of a load is small.

Key sets are theta sketches: exact up to ``2 ** lg`` distinct keys, beyond that with a relative error of about
``1 / sqrt(2 ** lg)`` of the larger set. Values are KLL sketches: exact up to ``k`` values, beyond that a quantile's rank is
off by about ``rank_error(k)``. A task keeps one sketch per column however many rows and copies it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

LG = 16
K = 2000
RANKS = tuple(i / 20 for i in range(1, 20))


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch, two-sided, at 99 % confidence. The published fit."""
    return 2.446 / k**0.9433


# --- drift without keys ---------------------------------------------------------------------------------


def value_sketches(df: DataFrame, columns: Sequence[str], k: int = K) -> DataFrame:
    """``column``, ``values`` (how many are not null) and ``sketch``, from one pass; of two loads, see ``merge_value_sketches``."""
    numbers = {c: F.col(f"`{c}`").cast("double") for c in columns}
    known = {c: F.when(~F.isnan(n), n) for c, n in numbers.items()}
    sketches = [F.struct(F.lit(c).alias("column"), F.count(v).alias("values"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")).alias(f"_{i}") for i, (c, v) in enumerate(known.items())]
    return df.agg(*sketches).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def merge_value_sketches(sketches: DataFrame) -> DataFrame:
    """Sketches of several loads as one per column."""
    return sketches.groupBy("column").agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile_ratios(raw: DataFrame, silver: DataFrame, ranks: Sequence[float] = RANKS) -> DataFrame:
    """Per column and rank: the quantiles of both layers' value sketches and their ratio, null where raw is 0."""
    at = F.array(*[F.lit(float(r)) for r in ranks])
    sides = []
    for layer, sketches in (("raw", raw), ("silver", silver)):
        found = F.when(F.col("values") > 0, F.kll_sketch_get_quantile_double(F.col("sketch"), at)).otherwise(F.transform(at, lambda r: F.nullif(r, r)))
        sides.append(sketches.select("column", found.alias(layer)))
    both = sides[0].join(sides[1], "column").withColumn("rank", at)
    rows = both.select("column", F.inline(F.arrays_zip("rank", "raw", "silver")))
    return rows.withColumn("ratio", F.try_divide("silver", "raw"))


def scale_drift_quantiles(raw: DataFrame, silver: DataFrame, columns: Sequence[str], ranks: Sequence[float] = RANKS, k: int = K) -> DataFrame:
    """Per column: the middle of the ratios of quantiles, and the lowest and highest ratio.

    Needs no keys: a change of scale moves all quantiles alike. A few outliers reach the outer ranks at most, copies of
    rows reach none if they are copies of any row alike. Equal lowest and highest ratios mean that one factor explains
    the change; if they differ, the column was changed in another way.
    """
    ratios = quantile_ratios(value_sketches(raw, columns, k), value_sketches(silver, columns, k), ranks)
    return ratios.groupBy("column").agg(F.median("ratio").alias("median_ratio"), F.min("ratio").alias("least_ratio"), F.max("ratio").alias("greatest_ratio"))


# --- traceability of keys -------------------------------------------------------------------------------


def key_sketch(df: DataFrame, keys: Sequence[str], lg: int = LG) -> DataFrame:
    """One row with the ``sketch`` of the distinct keys; a null part is a value like any other."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{k}`").cast("string")), F.lit("-")) for k in keys]
    return df.agg(F.theta_sketch_agg(F.to_json(F.array(*parts)), lg).alias("sketch"))


def merge_key_sketches(sketches: DataFrame, lg: int = LG) -> DataFrame:
    """Sketches of several loads, one row each, as the sketch of all their keys."""
    return sketches.agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def trace_keys(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """What ``key_traceability`` says, from two key sketches: keys in raw only, in silver only, in both, and the share found."""
    both = raw.select(F.col("sketch").alias("_raw"), F.lit(1).alias("_one")).join(silver.select(F.col("sketch").alias("_silver"), F.lit(1).alias("_one")), "_one")
    size = lambda sketch: F.theta_sketch_estimate(sketch)
    counted = both.select(
        size(F.theta_difference("_raw", "_silver")).alias("raw_only"),
        size(F.theta_difference("_silver", "_raw")).alias("silver_only"),
        size(F.theta_intersection("_raw", "_silver")).alias("matched"),
    )
    return counted.withColumn("matched_share", F.try_divide(F.col("matched"), F.col("matched") + F.col("raw_only")))


# --- where a column came from ---------------------------------------------------------------------------


def _forms(column: str, dtype: T.DataType) -> dict[str, Column]:
    """Texts a column's values may go by: as they are, without what stands before the last mark, and their digits."""
    value = F.col(f"`{column}`")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)):
        return {}
    if not isinstance(dtype, T.StringType):
        return {"value": value.cast("string")}
    plain = F.nullif(F.trim(F.lower(value)), F.lit(""))
    tail = F.nullif(F.regexp_extract(plain, r"^.*[-_:/#. ]([^-_:/#. ]+)$", 1), F.lit(""))
    digits = F.nullif(F.regexp_replace(F.regexp_replace(plain, "[^0-9]", ""), "^0+(?=.)", ""), F.lit(""))
    return {"value": plain, "tail": tail, "digits": digits}


def column_sketches(df: DataFrame, lg: int = 12) -> DataFrame:
    """``column``, ``form`` and ``sketch`` of the distinct values of every column in each form, from one pass."""
    forms = [(f.name, form, text) for f in df.schema.fields for form, text in _forms(f.name, f.dataType).items()]
    found = [F.struct(F.lit(c).alias("column"), F.lit(form).alias("form"), F.theta_sketch_agg(text, lg).alias("sketch")).alias(f"_{i}") for i, (c, form, text) in enumerate(forms)]
    return df.agg(*found).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(forms))])))


def column_origins(
    raw: DataFrame, silver: DataFrame, containment: float = 0.9, overlap: float = 0.2, least_values: int = 20, lg: int = 12
) -> DataFrame:
    """For columns of silver, the column of raw that their values came from, and the forms in which they agree.

    A column comes from another if ``containment`` of its distinct values are among the other's, if these are at least
    ``overlap`` of all values of both, and if it has at least ``least_values``: small ranges of numbers lie inside many
    columns. Of several, the one that shares most is named. Finds renamed columns, keys that got or lost a prefix
    or leading zeros, and columns that changed type. Columns without an origin have no row.

    All pairs of columns are compared, but what is compared is a sketch per column and form.
    """
    sides = [column_sketches(df, lg).select(F.col("column").alias(f"{layer}_column"), F.col("form").alias(f"{layer}_form"), F.col("sketch").alias(f"_{layer}")) for layer, df in (("raw", raw), ("silver", silver))]
    names = [(a, b) for a in raw.columns for b in silver.columns]
    pairs = raw.sparkSession.createDataFrame(names, "raw_column string, silver_column string")
    found = pairs.join(sides[0], "raw_column").join(sides[1], "silver_column").where("raw_form = 'value' or silver_form = 'value'")
    size = lambda sketch: F.theta_sketch_estimate(sketch).cast("double")
    shared, values, all_values = (size(c) for c in (F.theta_intersection("_raw", "_silver"), F.col("_silver"), F.theta_union("_raw", "_silver", F.lit(lg))))
    rated = found.select(
        "silver_column", "silver_form", "raw_column", "raw_form", values.alias("_values"), F.try_divide(shared, values).alias("contained"), F.try_divide(shared, all_values).alias("shared")
    ).where((F.col("_values") >= least_values) & (F.col("contained") >= containment) & (F.col("shared") >= overlap))
    # Of equally good pairs the plainer forms and the raw column's name decide.
    plain = lambda form: F.when(F.col(form) == "value", 0).when(F.col(form) == "tail", 1).otherwise(2)
    columns = ("raw_column", "raw_form", "silver_form", "contained", "shared")
    best = F.min_by(F.struct(*columns), F.struct(-F.round("shared", 2), plain("silver_form") + plain("raw_form"), "raw_column"))
    return rated.groupBy("silver_column").agg(best.alias("b")).select("silver_column", "b.*")
