"""Layers kept up to date: steps from SQL text, loads of new files, silver from the day's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierloom.plans import daily
from tierloom.plans.specs import load_step
from tierloom.session import scratch_dir
from tierloom.sources.readers import scan_table
from tierloom.sources.writers import materialize_layer
from tierloom.streaming.loads import load_emails_partitioned, load_emails_table
from workload.queries_contacts import GOLD_SQL, employments, phones
from workload.queries_emails import FIRST_THREADS, PARTITIONED_EMAILS, emails_in_order
from workload.registry import query
from workload.shapes import EMPLOYMENTS, PHONES

# --- steps from SQL text --------------------------------------------------------------------------------

_EMPLOYMENTS_STEP = {
    "dag.yaml": """
dag: {dag_id: employments_from_text}
source: {database: bronze, table: employments_raw}
target: {database: silver, table: contact_employments}
transformation: {query_file: query.sql}
processing: {deduplicate: true, remove_pii_tags: true, normalize_occupation: true}
""",
    "query.sql": r"""
-- Winners of bronze.employments_raw, one per contact, occupation and start date; the filter sees winners only.
WITH tidy AS (
  SELECT trimBoth(contact_id) AS contact_id,
    nullIf(trimBoth(toString(employer_name)), '') AS employer_name,
    nullIf(trimBoth(toString(title)), '') AS title,
    nullIf(lowerUTF8(trimBoth(replaceRegexpAll(occupation, '⟦[pP]:[^⟧]+⟧', ''))), '') AS occupation,
    start_date, toDateOrNull(toString(end_date)) AS end_date, ifNull(is_current, false) AS is_current,
    trimBoth(toString(organization_id)) AS organization_id, processing_date, row_id
  FROM bronze.employments_raw
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY contact_id, occupation, start_date
    ORDER BY is_current DESC, processing_date DESC, row_id) AS place
  FROM tidy
)
SELECT contact_id, employer_name, title, occupation, start_date, end_date, is_current, organization_id, processing_date
FROM ranked
WHERE place = 1 AND notEmpty(occupation) AND organization_id != 'org_pii_masking';
""",
    "tests.yaml": """
tests:
  - {name: rows, query: "SELECT COUNT(*) FROM silver.contact_employments", condition: "> 0"}
  - {column: contact_id, tests: [not_null]}
""",
}

_PHONES_STEP = {
    "dag.yaml": """
dag: {dag_id: phones_from_text}
source: {database: bronze, table: phones_raw}
target: {database: silver, table: contact_phones}
transformation: {query_file: query.sql}
""",
    "query.sql": r"""
SELECT contact_id, label, number, organization_id, processing_date
FROM (
  SELECT tidy.*, row_number() OVER (PARTITION BY contact_id, number ORDER BY processing_date DESC, row_id) AS place
  FROM (
    SELECT trimBoth(contact_id) AS contact_id, lowerUTF8(trimBoth(label)) AS label,
      replaceRegexpAll(replaceRegexpAll(number, '⟦PH:[^⟧]+⟧', ''), '[^0-9]', '') AS number,
      trimBoth(organization_id) AS organization_id, processing_date, row_id
    FROM bronze.phones_raw
  ) AS tidy
) AS ranked
WHERE place = 1 AND contact_id IS NOT NULL AND match(number, '^[0-9]{7,}$')
""",
    "tests.yaml": 'tests: [{name: rows, query: "SELECT COUNT(*) FROM silver.contact_phones", condition: "> 0"}]',
}

_GOLD_STEP = {
    "dag.yaml": """
dag: {dag_id: without_phone_from_text}
source: [{database: silver, table: contact_employments}, {database: silver, table: contact_phones}]
target: {database: gold, table: no_phone_by_org}
transformation: {query_file: query.sql}
""",
    "query.sql": """
SELECT e.organization_id, count(DISTINCT e.contact_id) AS contacts_without_phone
FROM silver.contact_employments AS e LEFT ANTI JOIN (SELECT DISTINCT contact_id FROM silver.contact_phones) AS p
  ON e.contact_id = p.contact_id
GROUP BY e.organization_id
ORDER BY contacts_without_phone DESC, e.organization_id
""",
    "tests.yaml": 'tests: [{name: rows, query: "SELECT COUNT(*) FROM gold.no_phone_by_org", condition: "> 0"}]',
}


def _materialized(spark, step: dict[str, str], locations: dict[str, str]) -> DataFrame:
    """Result of a step whose files are written to a folder and read from there."""
    folder = scratch_dir(spark)
    for name, text in step.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{folder}/{name}")
    return scan_table(spark, materialize_layer(spark, load_step(spark, folder, locations=locations)))


@query("SELECT * FROM silver_employments")
def materialize_from_sql_silver(spark, sf):
    raw = scratch_dir(spark)
    EMPLOYMENTS.spark(spark, sf).write.parquet(raw)
    return _materialized(spark, _EMPLOYMENTS_STEP, {"bronze.employments_raw": raw, "silver.contact_employments": scratch_dir(spark)})


@query("SELECT * FROM silver_phones")
def materialize_from_sql_phones(spark, sf):
    raw = scratch_dir(spark)
    PHONES.spark(spark, sf).write.parquet(raw)
    return _materialized(spark, _PHONES_STEP, {"bronze.phones_raw": raw, "silver.contact_phones": scratch_dir(spark)})


@query(GOLD_SQL["contacts_without_phone"])
def materialize_from_sql_gold(spark, sf):
    places = {name: scratch_dir(spark) for name in ("silver.contact_employments", "silver.contact_phones", "gold.no_phone_by_org")}
    employments(spark, sf).write.parquet(places["silver.contact_employments"])
    phones(spark, sf).write.parquet(places["silver.contact_phones"])
    return _materialized(spark, _GOLD_STEP, places)


# --- loads of new files ---------------------------------------------------------------------------------


def _land(rows: DataFrame, folder: str, files: int) -> None:
    """Add CSV files with these rows, in their order, to a folder."""
    rows.repartitionByRange(files, "_row").sortWithinPartitions("_row").drop("_row").write.mode("append").option("header", True).option("escape", '"').csv(folder)


def _in_two_runs(spark, sf, load) -> None:
    """Earlier rows land and are loaded, then later ones; a third run finds nothing new."""
    rows, folder, state = emails_in_order(spark, sf), scratch_dir(spark), scratch_dir(spark)
    middle = rows.agg(F.percentile_approx("_row", 0.5)).first()[0]
    for part in (rows.where(F.col("_row") <= middle), rows.where(F.col("_row") > middle)):
        _land(part, folder, 3)
        load(folder, state)
    if load(folder, state):
        raise AssertionError("files were read again")


@query(FIRST_THREADS)
def ingest_emails_table_new_files(spark, sf):
    target = scratch_dir(spark)
    _in_two_runs(spark, sf, lambda folder, state: load_emails_table(spark, folder, target, state, multi_line=True))
    return scan_table(spark, target)


@query(
    PARTITIONED_EMAILS.replace("FROM emails)", "FROM emails_dated)").replace(
        "customer_satisfaction AS customer_satisfaction", "cast(customer_satisfaction AS varchar) AS customer_satisfaction"
    )
)
def ingest_emails_partitioned_new_files(spark, sf):
    """One file a batch, so that a month has rows of many batches."""
    bucket = scratch_dir(spark)
    _in_two_runs(spark, sf, lambda folder, state: load_emails_partitioned(spark, folder, bucket, state, multi_line=True, files_per_batch=1))
    return scan_table(spark, f"{bucket}/customer_care_emails").drop("load")


# --- silver from the day's rows -------------------------------------------------------------------------


def _day_by_day(raw: DataFrame, update) -> DataFrame:
    """Each processing date on its own, the latest one second and again at the end."""
    days = sorted(r[0] for r in raw.select("processing_date").distinct().collect())
    for day in (days[0], days[-1], *days[1:-1], days[-1]):
        out = update(raw.where(F.col("processing_date") == day))
    return out


@query("SELECT * FROM silver_employments")
def silver_employments_by_day(spark, sf):
    path = scratch_dir(spark)
    return _day_by_day(EMPLOYMENTS.spark(spark, sf), lambda day: daily.update_employments(spark, day, path, tie_break=["row_id"]))


@query("SELECT * FROM silver_phones")
def silver_phones_by_day(spark, sf):
    path = scratch_dir(spark)
    return _day_by_day(PHONES.spark(spark, sf), lambda day: daily.update_phones(spark, day, path, tie_break=["row_id"]))
