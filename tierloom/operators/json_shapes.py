"""JSON text of unknown shape: what is in it, which of it is broken, and its fields as columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

VARIANT = "_variant"


def json_value(c: Column) -> Column:
    """JSON text of any shape as a variant; null for text that is no JSON, or that repeats a key of an object.

    The parser stops behind the first value, so a text counts only if it is the one item of a list made of it.
    """
    return F.when(F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1, F.try_parse_json(c))


def json_report(df: DataFrame, column: str) -> DataFrame:
    """One row: ``rows``, ``nulls``, ``bad`` (text that is no JSON) and ``schema``, the merged schema of all the rest.

    One pass; schemas are merged where rows are read. A field that is a number here and a text there is a VARIANT in it.
    """
    text = F.col(f"`{column}`")
    return df.select(text.alias("text"), json_value(text).alias(VARIANT)).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("text").isNull()).alias("nulls"),
        F.count_if(F.col("text").isNotNull() & F.col(VARIANT).isNull()).alias("bad"),
        F.schema_of_variant_agg(VARIANT).alias("schema"),
    )


def json_fields(df: DataFrame, column: str, depth: int = 3) -> DataFrame:
    """``path``, ``type`` and ``values``: every field down to a depth, with the types it has and how often.

    Items of a list share the path of the list with ``[*]``. Deeper values are counted as what they are where the depth ends.
    """
    spark = df.sparkSession
    level = df.select(F.lit("$").alias("path"), json_value(F.col(f"`{column}`")).alias(VARIANT)).where(F.col(VARIANT).isNotNull())
    kind = F.regexp_extract(F.schema_of_variant(VARIANT), "^[A-Z]+", 0)
    found = []
    for step in range(depth + 1):
        typed = level.withColumn("type", kind)
        found.append(typed.groupBy("path", "type").agg(F.count("*").alias("values")))
        if step < depth:
            inner = "select path || if(type = 'ARRAY', '[*]', '.' || e.key) as path, e.value as {} from {{typed}}, lateral variant_explode({}) as e where type in ('OBJECT', 'ARRAY')"
            level = spark.sql(inner.format(VARIANT, VARIANT), typed=typed)
    out = found[0]
    for counts in found[1:]:
        out = out.unionByName(counts)
    return out


def with_json_fields(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], bad: str = "") -> DataFrame:
    """All columns and the named fields, each from its path as its type; null where absent or of another type.

    ``bad`` names a flag for text that is no JSON. The text is parsed once for all fields.
    """
    text = F.col(f"`{column}`")
    parsed = df.withColumn(VARIANT, json_value(text))
    values = {name: F.try_variant_get(F.col(VARIANT), path, dtype) for name, (path, dtype) in fields.items()}
    if bad:
        values[bad] = text.isNotNull() & F.col(VARIANT).isNull()
    return parsed.withColumns(values).drop(VARIANT)
