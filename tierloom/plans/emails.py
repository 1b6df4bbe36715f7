"""Two loads of customer care emails: into a keyed table, and into partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tierloom.functions import norm_str, parse_timestamp, to_number
from tierloom.operators.cleaning import require_not_null, trim_strings
from tierloom.operators.contracts import (
    ColumnRule,
    Contract,
    check_columns_ordered,
    check_columns_set,
)
from tierloom.sources.readers import FILE_ORDER, gate_input_exists, scan_csv
from tierloom.sources.writers import create_table_if_absent, insert_if_absent, publish_to_uri

# Columns of the email file, in order.
EMAIL_COLUMNS = (
    "subject", "sender", "receiver", "timestamp", "message_body", "thread_id", "email_types", "email_status",
    "email_criticality", "product_types", "agent_effectivity", "agent_efficiency", "customer_satisfaction",
)

# Words the contract allows.
EMAIL_TYPES = ("inquiry", "issue", "suggestion", "complaint", "feedback")
EMAIL_STATUS = ("ongoing", "completed", "pending", "escalated")
CRITICALITY = ("low", "medium", "high", "critical")
PRODUCT_TYPES = ("Mercury Language", "API Development", "API monitoring", "Cloud management", "IAM service")
RATING = ("very low", "low", "medium", "high", "very high")
THREAD_ID = r"^aa\d{3}-[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}$"

# Contract of the keyed table: text throughout, the first six columns must be there, one row per thread.
TABLE_CONTRACT = Contract(
    "customer_care_emails",
    tuple(
        ColumnRule(
            name,
            {"timestamp": "timestamp", "customer_satisfaction": "numeric"}.get(name, "text"),
            nullable=i >= 6,
        )
        for i, name in enumerate(EMAIL_COLUMNS)
    ),
    primary_key=("thread_id",),
)

# Contract of the partitioned dataset, with rules on values.
DATASET_CONTRACT = Contract(
    "customer_care_emails",
    (
        ColumnRule("subject", nullable=False, max_length=500),
        ColumnRule("sender", nullable=False, max_length=255, format="email"),
        ColumnRule("receiver", nullable=False, max_length=255, format="email"),
        ColumnRule("timestamp", "timestamp", nullable=False, format="%Y-%m-%d %H:%M:%S%z"),
        ColumnRule("message_body", nullable=False, max_length=10000),
        ColumnRule("thread_id", nullable=False, pattern=THREAD_ID),
        ColumnRule("email_types", "array", nullable=False, allowed_values=EMAIL_TYPES),
        ColumnRule("email_status", nullable=False, allowed_values=EMAIL_STATUS),
        ColumnRule("email_criticality", nullable=False, allowed_values=CRITICALITY),
        ColumnRule("product_types", "array", nullable=False, allowed_values=PRODUCT_TYPES),
        ColumnRule("agent_effectivity", nullable=False, allowed_values=RATING),
        ColumnRule("agent_efficiency", nullable=False, allowed_values=RATING),
        ColumnRule("customer_satisfaction", "float", nullable=False, min_value=-1.0, max_value=1.0),
    ),
    quality_rules={
        "valid_email_format": ("sender", "receiver"),
        "timestamp_in_past": ("timestamp",),
        "non_empty_message": ("message_body",),
        "satisfaction_range": ("customer_satisfaction",),
    },
)


def filter_status_not_done(df: DataFrame, column: str = "email_status") -> DataFrame:
    """Drop finished threads, whatever the case; rows without a status stay."""
    return df.where(~norm_str(F.col(column)).eqNullSafe(F.lit("done"))) if column in df.columns else df


def drop_unparsable_timestamps(
    df: DataFrame, column: str = "timestamp", dropped: Observation | None = None
) -> DataFrame:
    """Parse the column and drop rows where that fails; ``dropped`` reports how many as the job runs."""
    parsed = df.withColumn(column, parse_timestamp(F.col(column).cast("string")))
    if dropped is not None:
        parsed = parsed.observe(dropped, F.count_if(F.col(column).isNull()).alias("dropped_rows"))
    return parsed.dropna(subset=[column])


def derive_year_month(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Partition columns, taken in UTC."""
    return df.withColumns({"year": F.year(column), "month": F.month(column)})


def prepare_for_table(emails: DataFrame) -> DataFrame:
    """Trimmed, without finished threads, typed as the table declares, required columns enforced.

    A column that starts with an underscore, such as the file order, is not part of the contract.
    """
    check_columns_ordered(emails.select(*[c for c in emails.columns if not c.startswith("_")]), TABLE_CONTRACT)
    open_threads = filter_status_not_done(trim_strings(emails))
    typed = open_threads.withColumns(
        {
            "timestamp": parse_timestamp(F.col("timestamp").cast("string")),
            "customer_satisfaction": to_number(F.col("customer_satisfaction")).cast("decimal(38,10)"),
        }
    )
    return require_not_null(typed, [c.name for c in TABLE_CONTRACT.columns if not c.nullable])


def prepare_for_dataset(emails: DataFrame, dropped: Observation | None = None) -> DataFrame:
    """Trimmed, with parsed timestamps and partition columns."""
    trimmed = trim_strings(check_columns_set(emails, DATASET_CONTRACT))
    return derive_year_month(drop_unparsable_timestamps(trimmed, dropped=dropped))


def ingest_emails_table(spark: SparkSession, csv: str, target: str, *, multi_line: bool) -> str:
    """CSV to the keyed table: gate, contract, clean, create if absent, insert if absent.

    ``multi_line`` has to be chosen: with line breaks inside quotes a file is read by one task, whatever its size.
    """
    gate_input_exists(spark, csv)
    emails = scan_csv(spark, csv, multi_line=multi_line, file_order=True)
    if "/" not in target:
        create_table_if_absent(spark, target, TABLE_CONTRACT.struct())
    return insert_if_absent(prepare_for_table(emails), target, TABLE_CONTRACT.primary_key, [FILE_ORDER])


def ingest_emails_partitioned(
    spark: SparkSession,
    csv: str,
    bucket: str,
    *,
    multi_line: bool,
    dropped: Observation | None = None,
) -> str:
    """CSV to Parquet by year and month below ``bucket``: gate, contract, clean, one write."""
    gate_input_exists(spark, csv)
    emails = scan_csv(spark, csv, multi_line=multi_line)
    return publish_to_uri(prepare_for_dataset(emails, dropped), bucket, DATASET_CONTRACT.name)
