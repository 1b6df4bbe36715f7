"""Silver, gold, their building blocks and checks: contacts made from orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierloom.functions import (
    coalesce_false,
    digits_only,
    empty_to_null,
    matches,
    strip_phone_tags,
    strip_pii_tags,
    trim_both,
    try_date,
)
from tierloom.operators import quality as Q
from tierloom.operators.aggregates import count_violations, duplicate_keys, order_by_metric
from tierloom.operators.dedupe import dedupe_employments, dedupe_phones
from tierloom.operators.joins import anti_join_distinct
from tierloom.plans import gold, silver
from tierloom.session import scratch_dir
from tierloom.sources.readers import scan_table
from tierloom.plans.specs import load_checks, load_spec
from tierloom.sources.writers import TransformSpec, materialize_layer, write_orc
from workload.registry import query
from workload.shapes import EMPLOYMENTS, PHONES


def employments(spark, sf) -> DataFrame:
    return silver.silver_contact_employments(EMPLOYMENTS.spark(spark, sf), tie_break=["row_id"])


def phones(spark, sf) -> DataFrame:
    return silver.silver_contact_phones(PHONES.spark(spark, sf), tie_break=["row_id"])


# --- sources and sinks ----------------------------------------------------------------------------------


@query("SELECT * FROM customer")
def scan_bronze(spark, sf):
    return scan_table(spark, f"{sf}/customer.parquet")


@query("SELECT * FROM silver_employments")
def scan_silver(spark, sf):
    path = scratch_dir(spark)
    employments(spark, sf).write.parquet(path)
    return scan_table(spark, path)


@query("SELECT * FROM silver_employments", name="write_orc")
def write_orc_table(spark, sf):
    return scan_table(spark, write_orc(employments(spark, sf), scratch_dir(spark)), "orc")


@query("SELECT organization_id, count(DISTINCT contact_id) AS contact_count FROM silver_employments GROUP BY ALL", name="materialize_layer")
def materialize_layers(spark, sf):
    """Built twice: first from rows that all get a later date, so the rebuild must remove partitions. Silver is ORC."""
    raw, refined, metric = (scratch_dir(spark) for _ in range(3))
    to_silver = TransformSpec(
        "contact_employments",
        {"raw": raw},
        refined,
        lambda raw: silver.silver_contact_employments(raw, tie_break=["row_id"]),
        fmt="orc",
        partition_by=["processing_date"],
        checks=Q.employment_checks(),
    )
    to_gold = TransformSpec(
        "contacts_by_org", {"employments": refined}, metric, gold.contacts_by_org, source_formats={"employments": "orc"}
    )
    given = EMPLOYMENTS.spark(spark, sf)
    for source in (given.withColumn("processing_date", F.date_add("processing_date", 40)), given):
        source.write.mode("overwrite").parquet(raw)
        for spec in (to_silver, to_gold):
            materialize_layer(spark, spec)
    return scan_table(spark, metric)


_SILVER_YAML = """
dag: {dag_id: employments}
source: {database: bronze, table: employments_raw}
target: {database: silver, table: contact_employments}
processing: {deduplicate: true, remove_pii_tags: true, normalize_occupation: false}
"""

_CHECKS_YAML = """
tests:
  - {name: row_count_check, query: "SELECT COUNT(*) FROM silver.contact_employments", condition: "> 0"}
  - name: short_titles
    query: SELECT COUNT(*) FROM silver.contact_employments WHERE match(title, '^[FO] ')
    condition: "> 100000000"
  - name: busy_contacts
    query: |
      SELECT contact_id, COUNT(*) FROM silver.contact_employments
      GROUP BY contact_id HAVING COUNT(*) > 3
    condition: "= 0"
  - {column: organization_id, tests: [not_null]}
  - {column: title, tests: [not_null]}
"""


@query(
    " UNION ALL ".join(
        f"(SELECT '{name}' AS \"check\", observed, '{condition}' AS condition, observed {condition} AS passed FROM ({sql}) AS x)"
        for name, condition, sql in (
            ("row_count_check", "> 0", "SELECT count(*) AS observed FROM silver_employments"),
            ("short_titles", "> 100000000", "SELECT count(*) AS observed FROM silver_employments WHERE regexp_matches(title, '^[FO] ')"),
            ("busy_contacts", "= 0", "SELECT count(*) AS observed FROM (SELECT contact_id FROM silver_employments GROUP BY ALL HAVING count(*) > 3) AS g"),
            ("organization_id_not_null", "= 0", "SELECT count(*) FILTER (WHERE organization_id IS NULL) AS observed FROM silver_employments"),
            ("title_not_null", "= 0", "SELECT count(*) FILTER (WHERE title IS NULL) AS observed FROM silver_employments"),
        )
    )
)
def run_checks_from_spec(spark, sf):
    return Q.run_checks(employments(spark, sf), load_checks(_CHECKS_YAML, "silver.contact_employments"))


@query(
    "SELECT contact_id, nullif(trim(regexp_replace(occupation, '⟦[pP]:[^⟧]+⟧', '', 'g')), '') AS occupation, organization_id FROM ("
    "SELECT trim(contact_id) AS contact_id, occupation, trim(organization_id) AS organization_id, start_date, processing_date, row_id, "
    "coalesce(is_current, false) AS is_current, trim(regexp_replace(occupation, '⟦[pP]:[^⟧]+⟧', '', 'g')) AS o FROM employments_raw) AS e "
    "QUALIFY row_number() OVER (PARTITION BY contact_id, nullif(o, ''), start_date ORDER BY is_current DESC, processing_date DESC, row_id) = 1 "
    "AND nullif(o, '') IS NOT NULL AND organization_id <> 'org_pii_masking'"
)
def materialize_from_spec(spark, sf):
    """Silver from its YAML, with the case of occupations left as it is."""
    raw, refined = scratch_dir(spark), scratch_dir(spark)
    EMPLOYMENTS.spark(spark, sf).write.parquet(raw)
    places = {"bronze.employments_raw": raw, "silver.contact_employments": refined}
    spec = load_spec(_SILVER_YAML, locations=places, tie_break=["row_id"], partition_by=["processing_date"])
    materialize_layer(spark, spec)
    return scan_table(spark, refined).select("contact_id", "occupation", "organization_id")


# --- silver ---------------------------------------------------------------------------------------------


@query("SELECT * FROM silver_employments")
def silver_contact_employments(spark, sf):
    return employments(spark, sf)


@query("SELECT * FROM silver_phones")
def silver_contact_phones(spark, sf):
    return phones(spark, sf)


@query("SELECT * FROM best_employments", name="dedupe_employments")
def dedupe_employments_by_key(spark, sf):
    return dedupe_employments(silver.clean_employments(EMPLOYMENTS.spark(spark, sf)), tie_break=["row_id"])


@query("SELECT * FROM best_phones", name="dedupe_phones")
def dedupe_phones_by_key(spark, sf):
    return dedupe_phones(silver.clean_phones(PHONES.spark(spark, sf)), tie_break=["row_id"])


@query(
    "SELECT * FROM clean_employments WHERE occupation IS NOT NULL AND organization_id <> 'org_pii_masking'",
)
def silver_employment_filter(spark, sf):
    return silver.clean_employments(EMPLOYMENTS.spark(spark, sf)).where(silver.employment_filter())


@query(
    "SELECT * FROM clean_phones WHERE contact_id IS NOT NULL AND number IS NOT NULL AND length(number) >= 7",
)
def silver_phone_filter(spark, sf):
    return silver.clean_phones(PHONES.spark(spark, sf)).where(silver.phone_filter())


@query("SELECT * FROM silver_phones WHERE organization_id <> 'org_pii_masking'")
def filter_masked_orgs(spark, sf):
    return silver.silver_contact_phones(PHONES.spark(spark, sf), remove_masked=True, tie_break=["row_id"])


@query("SELECT * FROM silver_employments WHERE is_current")
def filter_current(spark, sf):
    return gold.filter_current(employments(spark, sf))


@query("SELECT * FROM silver_phones WHERE label IS NOT NULL")
def filter_dimension_not_null(spark, sf):
    return gold.filter_dimension_not_null(phones(spark, sf), "label")


# --- scalar functions -----------------------------------------------------------------------------------


def _raw(spark, sf, name: str, column) -> DataFrame:
    return EMPLOYMENTS.spark(spark, sf).select("row_id", column.alias(name))


@query("SELECT row_id, trim(contact_id) AS contact_id FROM employments_raw", name="trim_both")
def trim_both_ends(spark, sf):
    return _raw(spark, sf, "contact_id", trim_both(F.col("contact_id")))


@query("SELECT o_orderkey, cast(o_custkey AS varchar) AS custkey FROM orders")
def to_string(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.col("o_custkey").cast("string").alias("custkey"))


@query("SELECT row_id, nullif(trim(employer_name), '') AS employer_name FROM employments_raw", name="empty_to_null")
def empty_to_null_text(spark, sf):
    return _raw(spark, sf, "employer_name", empty_to_null(F.col("employer_name")))


@query("SELECT row_id, lower(label) AS label FROM phones_raw")
def lower_case(spark, sf):
    return PHONES.spark(spark, sf).select("row_id", F.lower("label").alias("label"))


@query("SELECT row_id, regexp_replace(occupation, '⟦[pP]:[^⟧]+⟧', '', 'g') AS occupation FROM employments_raw", name="strip_pii_tags")
def strip_pii_tag_marks(spark, sf):
    return _raw(spark, sf, "occupation", strip_pii_tags(F.col("occupation")))


@query("SELECT row_id, regexp_replace(number, '⟦PH:[^⟧]+⟧', '', 'g') AS number FROM phones_raw", name="strip_phone_tags")
def strip_phone_tag_marks(spark, sf):
    return PHONES.spark(spark, sf).select("row_id", strip_phone_tags(F.col("number")).alias("number"))


@query("SELECT row_id, regexp_replace(number, '[^0-9]', '', 'g') AS number FROM phones_raw", name="digits_only")
def digits_only_number(spark, sf):
    return PHONES.spark(spark, sf).select("row_id", digits_only(F.col("number")).alias("number"))


@query("SELECT row_id, try_cast(end_date AS date) AS end_date FROM employments_raw", name="try_date")
def try_date_text(spark, sf):
    return _raw(spark, sf, "end_date", try_date(F.col("end_date")))


@query("SELECT row_id, coalesce(is_current, false) AS is_current FROM employments_raw", name="coalesce_false")
def coalesce_false_flag(spark, sf):
    return _raw(spark, sf, "is_current", coalesce_false(F.col("is_current")))


@query("SELECT row_id, cast(length(number) AS int) AS number_length FROM clean_phones")
def str_length(spark, sf):
    cleaned = silver.clean_phones(PHONES.spark(spark, sf))
    return cleaned.select("row_id", F.length("number").alias("number_length"))


@query("SELECT row_id, regexp_matches(trim(contact_id), '^[0-9a-f-]{36}$') AS is_uuid FROM employments_raw")
def regex_match(spark, sf):
    return _raw(spark, sf, "is_uuid", matches(F.trim("contact_id"), Q.CONTACT_ID))


# --- gold -----------------------------------------------------------------------------------------------


GOLD_SQL = {
    "contacts_by_org": "SELECT organization_id, count(DISTINCT contact_id) AS contact_count FROM silver_employments GROUP BY ALL",
    "contacts_by_occupation": "SELECT occupation, count(DISTINCT contact_id) AS contact_count FROM silver_employments "
    "WHERE occupation IS NOT NULL GROUP BY ALL ORDER BY contact_count DESC, occupation",
    "current_employments": "SELECT organization_id, count(DISTINCT contact_id) AS current_employment_count "
    "FROM silver_employments WHERE is_current GROUP BY ALL ORDER BY current_employment_count DESC, organization_id",
    "contacts_with_phone": "SELECT organization_id, count(DISTINCT contact_id) AS contacts_with_phone FROM silver_phones "
    "GROUP BY ALL ORDER BY contacts_with_phone DESC, organization_id",
    "contacts_without_phone": "SELECT organization_id, count(*) AS contacts_without_phone FROM without_phone "
    "GROUP BY ALL ORDER BY contacts_without_phone DESC, organization_id",
    "phone_type_distribution": "SELECT label, count(*) AS phone_count FROM silver_phones WHERE label IS NOT NULL "
    "GROUP BY ALL ORDER BY phone_count DESC, label",
}
GOLD_COLUMNS = {
    "contacts_by_org": ("organization_id", "contact_count"),
    "contacts_by_occupation": ("occupation", "contact_count"),
    "current_employments": ("organization_id", "current_employment_count"),
    "contacts_with_phone": ("organization_id", "contacts_with_phone"),
    "contacts_without_phone": ("organization_id", "contacts_without_phone"),
    "phone_type_distribution": ("label", "phone_count"),
}


@query(GOLD_SQL["contacts_by_org"])
def gold_contacts_by_org(spark, sf):
    return gold.contacts_by_org(employments(spark, sf))


@query(GOLD_SQL["contacts_by_occupation"])
def gold_contacts_by_occupation(spark, sf):
    return gold.contacts_by_occupation(employments(spark, sf))


@query(GOLD_SQL["current_employments"])
def gold_current_employments(spark, sf):
    return gold.current_employments(employments(spark, sf))


@query(GOLD_SQL["contacts_with_phone"])
def gold_contacts_with_phone(spark, sf):
    return gold.contacts_with_phone(phones(spark, sf))


@query(GOLD_SQL["contacts_without_phone"])
def gold_contacts_without_phone(spark, sf):
    return gold.contacts_without_phone(employments(spark, sf), phones(spark, sf))


@query(GOLD_SQL["phone_type_distribution"])
def gold_phone_type_distribution(spark, sf):
    return gold.phone_type_distribution(phones(spark, sf))


@query(
    "SELECT organization_id, coalesce(w, 0) AS contacts_with_phone, coalesce(n, 0) AS contacts_without_phone, "
    "round(100.0::double * coalesce(w, 0) / (coalesce(w, 0) + coalesce(n, 0)), 4) AS phone_coverage_pct "
    "FROM (SELECT organization_id, count(DISTINCT contact_id) AS w FROM silver_phones GROUP BY ALL) a "
    "FULL JOIN (SELECT organization_id, count(*) AS n FROM without_phone GROUP BY ALL) b USING (organization_id)"
)
def gold_phone_coverage_pct(spark, sf):
    return gold.phone_coverage_pct(employments(spark, sf), phones(spark, sf))


@query("SELECT count(DISTINCT contact_id) AS total_current_employed FROM silver_employments WHERE is_current")
def gold_total_current_employed(spark, sf):
    return gold.total_current_employed(employments(spark, sf))


@query("SELECT contact_id, organization_id FROM without_phone")
def anti_join_no_phone(spark, sf):
    keep = ["contact_id", "organization_id"]
    return anti_join_distinct(employments(spark, sf), phones(spark, sf), "contact_id", keep)


@query("SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY ALL ORDER BY orders DESC, o_orderpriority")
def order_by_metric_desc(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return order_by_metric(orders.groupBy("o_orderpriority").agg(F.count("*").alias("orders")), "orders", "o_orderpriority")


# --- checks ---------------------------------------------------------------------------------------------


def _check_sql(name: str, observed: str, source: str, condition: str = "= 0") -> str:
    return (
        f"SELECT '{name}' AS \"check\", observed, '{condition}' AS condition, observed {condition} AS passed "
        f"FROM (SELECT {observed} AS observed FROM {source}) AS counted"
    )


def _rows(where: str) -> str:
    return f"count(*) FILTER (WHERE {where})"


def _one(spark, sf, check: Q.Check, table=employments) -> DataFrame:
    return Q.run_checks(table(spark, sf), [check])


_DUPLICATES = "(SELECT 1 FROM silver_employments GROUP BY contact_id, occupation, start_date HAVING count(*) > 1) AS g"
_DUPLICATE_PHONES = "(SELECT 1 FROM silver_phones GROUP BY contact_id, number HAVING count(*) > 1) AS g"

EMPLOYMENT_CHECKS_SQL = {
    "row_count_check": _check_sql("row_count_check", "count(*)", "silver_employments", "> 0"),
    "contact_id_not_null": _check_sql("contact_id_not_null", _rows("contact_id IS NULL"), "silver_employments"),
    "valid_uuid_contact_id": _check_sql(
        "valid_uuid_contact_id", _rows("NOT regexp_matches(contact_id, '^[0-9a-f-]{36}$')"), "silver_employments"
    ),
    "start_date_valid": _check_sql("start_date_valid", _rows("start_date IS NULL"), "silver_employments"),
    "pii_tags_removed": _check_sql("pii_tags_removed", _rows("regexp_matches(occupation, '⟦[pP]:')"), "silver_employments"),
    "remove_pii_masking_rows": _check_sql(
        "remove_pii_masking_rows", _rows("organization_id = 'org_pii_masking'"), "silver_employments"
    ),
    "duplicate_employment_check": _check_sql("duplicate_employment_check", "count(*)", _DUPLICATES),
}


@query(EMPLOYMENT_CHECKS_SQL["row_count_check"])
def check_row_count(spark, sf):
    return _one(spark, sf, Q.row_count())


@query(EMPLOYMENT_CHECKS_SQL["contact_id_not_null"])
def check_contact_id_not_null(spark, sf):
    return _one(spark, sf, Q.not_null("contact_id"))


@query(EMPLOYMENT_CHECKS_SQL["valid_uuid_contact_id"])
def check_uuid_format(spark, sf):
    return _one(spark, sf, Q.uuid_format())


@query(EMPLOYMENT_CHECKS_SQL["start_date_valid"])
def check_start_date_present(spark, sf):
    return _one(spark, sf, Q.start_date_present())


@query(_check_sql("pii_tags_removed", _rows("regexp_matches(occupation, '⟦[pP]:')"), "employments_raw"))
def check_pii_tags_removed(spark, sf):
    return _one(spark, sf, Q.pii_tags_removed(), EMPLOYMENTS.spark)


@query(_check_sql("remove_pii_masking_rows", _rows("organization_id = 'org_pii_masking'"), "silver_phones"))
def check_masked_rows_removed(spark, sf):
    return _one(spark, sf, Q.masked_rows_removed(), phones)


@query(
    _check_sql(
        "duplicate_employment_check",
        "count(*)",
        "(SELECT 1 FROM clean_employments GROUP BY contact_id, occupation, start_date HAVING count(*) > 1) AS g",
    )
)
def check_duplicate_employments(spark, sf):
    keys = ["contact_id", "occupation", "start_date"]
    cleaned = silver.clean_employments(EMPLOYMENTS.spark(spark, sf))
    return Q.run_checks(cleaned, [Q.no_duplicates(keys, "duplicate_employment_check")])


@query(_check_sql("phone_number_not_null", _rows("number IS NULL"), "silver_phones"))
def check_phone_not_null(spark, sf):
    return _one(spark, sf, Q.not_null("number", "phone_number_not_null"), phones)


@query(_check_sql("phone_number_length", _rows("length(number) < 7"), "clean_phones"))
def check_phone_length(spark, sf):
    return Q.run_checks(silver.clean_phones(PHONES.spark(spark, sf)), [Q.phone_length()])


@query(_check_sql("duplicate_phone_check", "count(*)", _DUPLICATE_PHONES))
def check_duplicate_phones(spark, sf):
    return _one(spark, sf, Q.no_duplicates(["contact_id", "number"], "duplicate_phone_check"), phones)


def _gold_check_sql() -> str:
    parts = []
    for table, sql in GOLD_SQL.items():
        for column in GOLD_COLUMNS[table]:
            parts.append(
                f"(SELECT '{table}' AS \"table\", '{column}_not_null' AS \"check\", observed, '= 0' AS condition, "
                f"observed = 0 AS passed FROM (SELECT count(*) FILTER (WHERE {column} IS NULL) AS observed FROM ({sql}) AS g) AS x)"
            )
    return " UNION ALL ".join(parts)


@query(_gold_check_sql())
def check_gold_not_null(spark, sf):
    stored = [scratch_dir(spark), scratch_dir(spark)]
    employments(spark, sf).write.parquet(stored[0])
    phones(spark, sf).write.parquet(stored[1])
    e, p = (scan_table(spark, path) for path in stored)
    return Q.check_gold_not_null(
        {
            "contacts_by_org": gold.contacts_by_org(e),
            "contacts_by_occupation": gold.contacts_by_occupation(e),
            "current_employments": gold.current_employments(e),
            "contacts_with_phone": gold.contacts_with_phone(p),
            "contacts_without_phone": gold.contacts_without_phone(e, p),
            "phone_type_distribution": gold.phone_type_distribution(p),
        }
    )


@query(
    " UNION ALL ".join(
        f"(SELECT '{c}_not_blank' AS \"check\", observed, '= 0' AS condition, observed = 0 AS passed "
        f"FROM (SELECT count(*) FILTER (WHERE trim({c}) = '') AS observed FROM employments_raw) AS x)"
        for c in ("contact_id", "employer_name", "title")
    )
)
def check_empty_strings(spark, sf):
    return Q.run_checks(EMPLOYMENTS.spark(spark, sf), Q.empty_strings(["contact_id", "employer_name", "title"]))


@query(
    "SELECT 'freshness' AS \"check\", observed, '<= 7' AS condition, observed <= 7 AS passed FROM "
    "(SELECT cast(date '2026-03-25' - max(processing_date) AS bigint) AS observed FROM silver_employments) AS x"
)
def check_freshness(spark, sf):
    return Q.check_freshness(employments(spark, sf), "2026-03-25", 7)


@query(_check_sql("occupation_lowercase", _rows("occupation <> lower(occupation)"), "employments_raw"))
def check_occupation_lowercase(spark, sf):
    return _one(spark, sf, Q.occupation_lowercase(), EMPLOYMENTS.spark)


@query(" UNION ALL ".join(f"({sql})" for sql in EMPLOYMENT_CHECKS_SQL.values()))
def run_checks(spark, sf):
    return Q.run_checks(employments(spark, sf), Q.employment_checks())


@query("SELECT contact_id, number, count(*) AS row_count FROM clean_phones GROUP BY ALL HAVING count(*) > 1", name="duplicate_keys")
def duplicate_phone_keys(spark, sf):
    return duplicate_keys(silver.clean_phones(PHONES.spark(spark, sf)), ["contact_id", "number"])


@query(
    "SELECT unnest(['no_tax', 'bulk', 'unshipped']) AS \"check\", "
    "unnest([count(*) FILTER (WHERE l_tax = 0), count(*) FILTER (WHERE l_quantity > 40), "
    "count(*) FILTER (WHERE l_shipdate IS NULL)]) AS observed FROM lineitem",
    name="count_violations",
)
def lineitem_violations(spark, sf):
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    return count_violations(
        lineitem,
        {"no_tax": F.col("l_tax") == 0, "bulk": F.col("l_quantity") > 40, "unshipped": F.col("l_shipdate").isNull()},
    )
