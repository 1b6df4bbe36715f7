"""Silver to gold: contact and phone metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierloom.constants import ORG
from tierloom.operators.aggregates import distinct_count_by, order_by_metric
from tierloom.operators.joins import anti_join_distinct


def filter_current(employments: DataFrame) -> DataFrame:
    return employments.where(F.col("is_current"))


def filter_dimension_not_null(df: DataFrame, dimension: str) -> DataFrame:
    return df.where(F.col(dimension).isNotNull())


def contacts_by_org(employments: DataFrame, org: str = ORG) -> DataFrame:
    return distinct_count_by(employments, org, "contact_id", "contact_count")


def contacts_by_occupation(employments: DataFrame) -> DataFrame:
    known = filter_dimension_not_null(employments, "occupation")
    counts = distinct_count_by(known, "occupation", "contact_id", "contact_count")
    return order_by_metric(counts, "contact_count", "occupation")


def current_employments(employments: DataFrame, org: str = ORG) -> DataFrame:
    counts = distinct_count_by(filter_current(employments), org, "contact_id", "current_employment_count")
    return order_by_metric(counts, "current_employment_count", org)


def contacts_with_phone(phones: DataFrame, org: str = ORG) -> DataFrame:
    counts = distinct_count_by(phones, org, "contact_id", "contacts_with_phone")
    return order_by_metric(counts, "contacts_with_phone", org)


def _without_phone(employments: DataFrame, phones: DataFrame, org: str) -> DataFrame:
    # The pairs are distinct already, so a plain count is the distinct count.
    pairs = anti_join_distinct(employments, phones, "contact_id", ["contact_id", org])
    return pairs.groupBy(org).agg(F.count("contact_id").alias("contacts_without_phone"))


def contacts_without_phone(employments: DataFrame, phones: DataFrame, org: str = ORG) -> DataFrame:
    return order_by_metric(_without_phone(employments, phones, org), "contacts_without_phone", org)


def phone_type_distribution(phones: DataFrame) -> DataFrame:
    known = filter_dimension_not_null(phones, "label")
    return order_by_metric(known.groupBy("label").agg(F.count("*").alias("phone_count")), "phone_count", "label")


def phone_coverage_pct(employments: DataFrame, phones: DataFrame, org: str = ORG) -> DataFrame:
    """Contacts with a phone as a share of contacts with and without one, per organization."""
    having = distinct_count_by(phones, org, "contact_id", "contacts_with_phone")
    both = having.join(_without_phone(employments, phones, org), org, "full")
    counted = both.na.fill(0, ["contacts_with_phone", "contacts_without_phone"])
    share = F.col("contacts_with_phone") / (F.col("contacts_with_phone") + F.col("contacts_without_phone"))
    return counted.withColumn("phone_coverage_pct", F.round(share * 100.0, 4))


def total_current_employed(employments: DataFrame) -> DataFrame:
    """One total over all organizations."""
    return filter_current(employments).agg(F.count_distinct("contact_id").alias("total_current_employed"))
