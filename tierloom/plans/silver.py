"""Bronze to silver: clean, keep the best row per key, then filter the winners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tierloom.constants import MASKED_ORG, ORG, SHORTEST_NUMBER
from tierloom.functions import (
    coalesce_false,
    digits_only,
    empty_to_null,
    strip_phone_tags,
    strip_pii_tags,
    trim_both,
    try_date,
)
from tierloom.operators.dedupe import dedupe_employments, dedupe_phones

EMPLOYMENT_COLUMNS = (
    "contact_id", "employer_name", "title", "occupation", "start_date", "end_date", "is_current", ORG, "processing_date",
)
PHONE_COLUMNS = ("contact_id", "label", "number", ORG, "processing_date")


def _columns(names: Sequence[str], org: str) -> list[str]:
    return [org if c == ORG else c for c in names]


def clean_employments(
    raw: DataFrame, org: str = ORG, tagged: Sequence[str] = ("occupation",), normalize_occupation: bool = True
) -> DataFrame:
    """Trimmed text, blanks to null, tags removed from the ``tagged`` columns, bad dates to null."""
    cased = F.lower if normalize_occupation else (lambda c: c)

    def text(name: str) -> Column:
        return strip_pii_tags(F.col(name)) if name in tagged else F.col(name)

    return raw.withColumns(
        {
            "contact_id": trim_both(F.col("contact_id")),
            "employer_name": empty_to_null(text("employer_name")),
            "title": empty_to_null(text("title")),
            "occupation": empty_to_null(cased(text("occupation"))),
            "end_date": try_date(F.col("end_date")),
            "is_current": coalesce_false(F.col("is_current")),
            org: trim_both(F.col(org)),
        }
    )


def not_masked(org: str = ORG) -> Column:
    return F.col(org) != MASKED_ORG


def employment_filter(org: str = ORG) -> Column:
    """Has an occupation and a real organization; a row without an organization is dropped too."""
    return F.col("occupation").isNotNull() & not_masked(org)


def silver_contact_employments(
    raw: DataFrame,
    org: str = ORG,
    tie_break: Sequence[str] = (),
    *,
    deduplicate: bool = True,
    remove_pii_tags: bool = True,
    normalize_occupation: bool = True,
) -> DataFrame:
    """One row per contact, occupation and start date.

    The filter is applied to the winners: a masked row that wins its key takes its unmasked twin with it.
    The flags switch single steps off.
    """
    cleaned = clean_employments(raw, org, ("occupation",) if remove_pii_tags else (), normalize_occupation)
    where = employment_filter(org)
    best = dedupe_employments(cleaned, where, tie_break) if deduplicate else cleaned.where(where)
    return best.select(*_columns(EMPLOYMENT_COLUMNS, org))


def clean_phones(raw: DataFrame, org: str = ORG, normalize_phone_numbers: bool = True) -> DataFrame:
    """Lower-case label, digits-only number, trimmed ids."""
    number = digits_only(strip_phone_tags(F.col("number"))) if normalize_phone_numbers else trim_both(F.col("number"))
    return raw.withColumns(
        {
            "contact_id": trim_both(F.col("contact_id")),
            "label": F.lower(trim_both(F.col("label"))),
            "number": number,
            org: trim_both(F.col(org)),
        }
    )


def phone_filter() -> Column:
    """Has a contact and a number that is long enough."""
    long_enough = F.length("number") >= SHORTEST_NUMBER
    return F.col("contact_id").isNotNull() & F.col("number").isNotNull() & long_enough


def silver_contact_phones(
    raw: DataFrame,
    org: str = ORG,
    remove_masked: bool = False,
    tie_break: Sequence[str] = (),
    *,
    deduplicate: bool = True,
    normalize_phone_numbers: bool = True,
) -> DataFrame:
    """One row per contact and number. ``remove_masked`` also drops masked organizations; the flags switch steps off."""
    where = phone_filter() & not_masked(org) if remove_masked else phone_filter()
    cleaned = clean_phones(raw, org, normalize_phone_numbers)
    best = dedupe_phones(cleaned, where, tie_break) if deduplicate else cleaned.where(where)
    return best.select(*_columns(PHONE_COLUMNS, org))
