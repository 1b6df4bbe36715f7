"""Collects queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tierloom.session import configure
from workload.sql import build

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def naive_times(df: DataFrame) -> DataFrame:
    """Instants as wall clocks of the session zone (UTC), the form SQL engines compare."""
    if all(t != "timestamp" for _, t in df.dtypes):
        return df
    return df.select(*[df[c].cast("timestamp_ntz") if t == "timestamp" else df[c] for c, t in df.dtypes])


def query(sql: str | None = None, name: str | None = None, other: Mapping[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, or ``name``, with the SQL that gives the same rows.

    ``other`` replaces blocks the SQL is built from.
    """

    def register(function: Query) -> Query:
        key = name or function.__name__

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return naive_times(function(configure(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = build(sql, other)
        return function

    return register
