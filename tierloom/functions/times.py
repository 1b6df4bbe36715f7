"""Dates and timestamps. The session time zone is UTC (see ``session.configure``)."""

from __future__ import annotations

import json
import zoneinfo
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

__all__ = [
    "convert_utc_to_local",
    "offset_to_utc",
    "parse_timestamp",
    "same_month",
    "strip_timezone",
    "truncate_to_ms",
    "try_date",
    "zone_table",
]

# Names in the zone database the JVM does not resolve: two are no zones, one is an alias.
NO_ZONES = ("Factory", "localtime")
ZONE_ALIASES = {"ROC": "Asia/Taipei"}


def parse_timestamp(c: Column, *formats: str) -> Column:
    """Text to timestamp, null where it does not parse. ISO text needs no format."""
    attempts = [F.try_to_timestamp(c), *(F.try_to_timestamp(c, F.lit(f)) for f in formats)]
    return F.coalesce(*attempts) if formats else attempts[0]


def offset_to_utc(c: Column) -> Column:
    """``2025-11-04T01:12:03+07:00`` to the UTC instant."""
    return F.try_to_timestamp(c)


def try_date(c: Column) -> Column:
    """Text to date, null where it does not parse."""
    return F.try_to_date(c.cast("string"))


def strip_timezone(c: Column) -> Column:
    """Instant to the naive wall clock of the session zone."""
    return c.cast("timestamp_ntz")


def truncate_to_ms(c: Column) -> Column:
    return F.date_trunc("MILLISECOND", c)


def same_month(a: Column, b: Column) -> Column:
    """Year and month are equal."""
    return F.date_trunc("MONTH", a) == F.date_trunc("MONTH", b)


@cache
def _zone_rows() -> str:
    names = zoneinfo.available_timezones()
    if not names:
        raise RuntimeError("no time zone database on the driver")
    rows = [{"zone_key": n.lower(), "zone_id": ZONE_ALIASES.get(n, n)} for n in sorted(names - set(NO_ZONES))]
    return json.dumps(rows)


def zone_table(spark: SparkSession) -> DataFrame:
    """About 600 rows, one per known zone: lower-case name and the name the JVM resolves.

    Its size is fixed by the zone database, so a broadcast of it never grows with the data.
    """
    rows = F.from_json(F.lit(_zone_rows()), "array<struct<zone_key:string,zone_id:string>>")
    return spark.range(1).select(F.inline(rows))


def convert_utc_to_local(df: DataFrame, timestamps: list[str], zone: str | None) -> DataFrame:
    """UTC wall clocks to the wall clock of each row's zone.

    A zone that is null or unknown leaves the timestamp as it is; zone names are compared in any case.
    ``from_utc_timestamp`` raises for an unknown zone, so only names found in ``zone_table`` reach it.
    """
    shifted = [c for c in timestamps if c in df.columns]
    if zone is None or zone not in df.columns or not shifted:
        return df
    zones = F.broadcast(zone_table(df.sparkSession))
    joined = df.join(zones, F.lower(df[zone]) == zones["zone_key"], "left")
    return joined.select(
        *[
            F.coalesce(F.from_utc_timestamp(df[c], zones["zone_id"]), df[c].cast("timestamp")).alias(c)
            if c in shifted
            else df[c]
            for c in df.columns
        ]
    )
