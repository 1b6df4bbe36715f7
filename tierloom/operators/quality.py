"""Data-quality checks: observed value, condition, verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tierloom.constants import MASKED_ORG, ORG, SHORTEST_NUMBER
from tierloom.operators.aggregates import duplicate_keys

# Form of a contact id, and the start of a privacy tag.
CONTACT_ID = "^[0-9a-f-]{36}$"
PII_TAG_START = "⟦[pP]:"


@dataclass(frozen=True)
class Check:
    """A named count and the condition it must meet.

    ``rows_where`` counts rows (None: all rows), ``repeated`` counts keys with more than one row. ``query`` is
    Spark SQL over ``{table}``: its single number, or the number of its rows if it selects several columns.
    """

    name: str
    condition: str = "= 0"
    rows_where: Column | None = None
    repeated: Sequence[str] = ()
    query: str = ""


def _verdict(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """``df`` has one column per check, named by its position."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                F.col(f"_{i}").alias("observed"),
                F.lit(condition).alias("condition"),
                F.expr(f"_{i} {condition}").alias("passed"),
            )
            for i, (name, condition) in enumerate(conditions.items())
        ]
    )
    return df.select(F.inline(rows))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check``, ``observed``, ``condition``, ``passed``: row checks in one pass, one pass per key check."""
    parts = []
    row_checks = [c for c in checks if not c.repeated and not c.query]
    if row_checks:
        counts = [
            (F.count("*") if c.rows_where is None else F.count_if(c.rows_where)).alias(f"_{i}")
            for i, c in enumerate(row_checks)
        ]
        parts.append(_verdict(df.agg(*counts), {c.name: c.condition for c in row_checks}))
    for c in checks:
        if c.repeated:
            groups = duplicate_keys(df, c.repeated).agg(F.count("*").alias("_0"))
            parts.append(_verdict(groups, {c.name: c.condition}))
        elif c.query:
            found = df.sparkSession.sql(c.query, table=df)
            rows = F.count("*") if len(found.columns) > 1 else F.first(F.col(found.columns[0]).cast("long"))
            parts.append(_verdict(found.agg(rows.alias("_0")), {c.name: c.condition}))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- single checks ------------------------------------------------------------------------------------


def row_count() -> Check:
    return Check("row_count_check", "> 0")


def not_null(column: str, name: str | None = None) -> Check:
    return Check(name or f"{column}_not_null", rows_where=F.col(column).isNull())


def uuid_format(column: str = "contact_id") -> Check:
    return Check("valid_uuid_contact_id", rows_where=~F.col(column).rlike(CONTACT_ID))


def start_date_present() -> Check:
    return not_null("start_date", "start_date_valid")


def pii_tags_removed(column: str = "occupation") -> Check:
    return Check("pii_tags_removed", rows_where=F.col(column).rlike(PII_TAG_START))


def masked_rows_removed(org: str = ORG) -> Check:
    return Check("remove_pii_masking_rows", rows_where=F.col(org) == MASKED_ORG)


def no_duplicates(keys: Sequence[str], name: str) -> Check:
    """Counts the keys that occur more than once."""
    return Check(name, repeated=tuple(keys))


def phone_length() -> Check:
    return Check("phone_number_length", rows_where=F.length("number") < SHORTEST_NUMBER)


def empty_strings(columns: Sequence[str]) -> list[Check]:
    return [Check(f"{c}_not_blank", rows_where=F.trim(F.col(c)) == "") for c in columns]


def occupation_lowercase() -> Check:
    return Check("occupation_lowercase", rows_where=F.col("occupation") != F.lower("occupation"))


def check_freshness(df: DataFrame, as_of: str, days: int, column: str = "processing_date") -> DataFrame:
    """Age in days of the newest row at ``as_of``; passes if it is at most ``days``."""
    age = F.date_diff(F.lit(as_of).cast("date"), F.max(column)).cast("long")
    return _verdict(df.agg(age.alias("_0")), {"freshness": f"<= {days}"})


# --- check sets ---------------------------------------------------------------------------------------


def employment_checks(org: str = ORG) -> list[Check]:
    return [
        row_count(),
        not_null("contact_id"),
        uuid_format(),
        start_date_present(),
        pii_tags_removed(),
        masked_rows_removed(org),
        no_duplicates(["contact_id", "occupation", "start_date"], "duplicate_employment_check"),
    ]


def phone_checks(org: str = ORG) -> list[Check]:
    return [
        row_count(),
        not_null("contact_id"),
        not_null("number", "phone_number_not_null"),
        phone_length(),
        masked_rows_removed(org),
        no_duplicates(["contact_id", "number"], "duplicate_phone_check"),
    ]


def check_gold_not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every column of every metric table must be complete."""
    out = None
    for name, df in tables.items():
        found = run_checks(df, [not_null(c) for c in df.columns]).select(F.lit(name).alias("table"), "*")
        out = found if out is None else out.unionByName(found)
    return out
