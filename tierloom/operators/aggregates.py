"""Grouped counts shared by the metrics and the checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def order_by_metric(df: DataFrame, metric: str, dimension: str) -> DataFrame:
    """Highest metric first; the dimension settles ties."""
    return df.orderBy(F.desc(metric), dimension)


def distinct_count_by(df: DataFrame, dimension: str, counted: str, name: str) -> DataFrame:
    """Distinct values per group. Spark first reduces to distinct pairs, so a large group is spread out."""
    return df.groupBy(dimension).agg(F.count_distinct(counted).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def count_violations(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each predicate, counted in one pass: ``check``, ``observed``."""
    counts = df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("observed")) for n in predicates])
    return counts.select(F.inline(rows))


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    shapes = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    out = shapes[0]
    for shape in shapes[1:]:
        out = out.unionByName(shape)
    return out


def distinct_partition_values(df: DataFrame, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Partitions a write would touch."""
    return df.select(*by).distinct()
