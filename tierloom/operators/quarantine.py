"""Rows with the rules they break: good rows and the others apart, from one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tierloom.operators.contracts import Rule
from tierloom.sources.writers import publish, write_aside

BROKEN = "broken_rules"
ACCEPTED = "accepted"


def with_broken_rules(df: DataFrame, rules: Sequence[Rule], column: str = BROKEN) -> DataFrame:
    """All columns and the rules each row breaks, as ``rule:column`` in the order of the rules; empty for good rows."""
    names = [F.when(F.coalesce(broken, F.lit(False)), F.lit(f"{rule}:{c}")) for rule, c, broken in rules]
    return df.withColumn(column, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


@dataclass(frozen=True)
class Split:
    """Rows that break no rule, rows that do with ``broken_rules``, and how often each rule is broken."""

    good: DataFrame
    quarantine: DataFrame
    counts: DataFrame


def split_rows(df: DataFrame, rules: Sequence[Rule], path: str, fmt: str = "parquet") -> Split:
    """Write all rows below a path, laid out by whether they are accepted, and count broken rules on the way.

    The table is read once: the rules are worked out there, counted as rows pass, and rows go straight to the files
    of their side. What a former run left at the path is replaced when the new rows are all written.
    """
    spark: SparkSession = df.sparkSession
    counted = Observation("broken rules")
    numbers = [F.count_if(F.array_contains(BROKEN, f"{rule}:{column}")).alias(f"_{i}") for i, (rule, column, _) in enumerate(rules)]
    marked = with_broken_rules(df, rules).withColumn(ACCEPTED, F.size(BROKEN) == 0)
    # No rebalance: a task has two sides, so it writes two files at most.
    watched = marked.observe(counted, F.count("*").alias("rows"), *numbers)
    publish(spark, write_aside(watched, path, fmt, [ACCEPTED], rebalance=False), path)
    found = counted.get
    counts = [(rule, column, found[f"_{i}"], found[f"_{i}"] == 0) for i, (rule, column, _) in enumerate(rules)]
    stored = spark.read.schema(marked.schema).format(fmt).load(path)
    return Split(
        stored.where(ACCEPTED).drop(BROKEN, ACCEPTED),
        stored.where(~F.col(ACCEPTED)).drop(ACCEPTED),
        spark.createDataFrame(counts, "rule string, column string, violations long, passed boolean"),
    )

