"""Email loads and contract rules, on conversations shaped as emails."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tierloom.functions import parse_json_list, pseudonymize
from tierloom.operators import contracts as K
from tierloom.operators.aggregates import distinct_partition_values
from tierloom.plans import emails as M
from tierloom.session import scratch_dir
from tierloom.sources.readers import scan_table
from tierloom.sources.writers import insert_if_absent, publish_to_uri, write_partitioned_parquet
from workload.registry import query
from workload.shapes import EMAILS, EMAILS_DATED

AS_OF = datetime(2026, 2, 15)

_COLUMNS = ", ".join(f'"{c}"' for c in M.EMAIL_COLUMNS)
_TRIM = "trim({}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160) || chr(8239) || chr(12288))"
_SENT = "try_cast(replace(\"timestamp\", '+07:00', '') AS timestamp) - interval 7 hour"
_STORED = (
    f"SELECT trim(subject) AS subject, sender, receiver, {_SENT} AS \"timestamp\", {_TRIM.format('message_body')} AS message_body, "
    "thread_id, email_types, nullif(trim(email_status), '') AS email_status, email_criticality, product_types, "
    "agent_effectivity, agent_efficiency, {satisfaction} AS customer_satisfaction"
)
_KEYED = _STORED.format(satisfaction="cast(customer_satisfaction AS decimal(38, 10))")
_DATASET = _STORED.format(satisfaction="customer_satisfaction")
_NOT_DONE = "lower(trim(email_status)) IS DISTINCT FROM 'done'"


def _emails(spark, sf) -> DataFrame:
    return EMAILS.spark(spark, sf).drop("row_id")


def emails_in_order(spark, sf) -> DataFrame:
    """Emails with the columns of the file, in its row order."""
    return EMAILS_DATED.spark(spark, sf).withColumnRenamed("row_id", "_row")


def _csv(df: DataFrame) -> str:
    path = scratch_dir(df.sparkSession)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("SELECT * FROM emails WHERE lower(trim(email_status)) IS DISTINCT FROM 'done'")
def filter_status_not_done(spark, sf):
    return M.filter_status_not_done(EMAILS.spark(spark, sf))


@query(f'SELECT row_id, {_SENT} AS "timestamp" FROM emails WHERE {_SENT} IS NOT NULL')
def drop_unparsable_timestamps(spark, sf):
    return M.drop_unparsable_timestamps(EMAILS.spark(spark, sf).select("row_id", "timestamp"))


@query("SELECT event_id, cast(year(ts) AS int) AS year, cast(month(ts) AS int) AS month FROM events")
def derive_year_month(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    return M.derive_year_month(events, "ts").drop("ts")


PARTITIONED_EMAILS = (
    f"SELECT *, cast(year(\"timestamp\") AS int) AS year, cast(month(\"timestamp\") AS int) AS month FROM "
    f"({_DATASET} FROM emails) AS e WHERE \"timestamp\" IS NOT NULL"
)


@query(f"SELECT DISTINCT year, month FROM ({PARTITIONED_EMAILS}) AS p", name="distinct_partition_values")
def email_partition_values(spark, sf):
    return distinct_partition_values(M.prepare_for_dataset(_emails(spark, sf)))


@query(PARTITIONED_EMAILS, name="write_partitioned_parquet")
def written_partitions(spark, sf):
    """Written twice: the rerun replaces the partitions it holds."""
    ready, path = M.prepare_for_dataset(_emails(spark, sf)), scratch_dir(spark)
    for _ in range(2):
        write_partitioned_parquet(ready, path)
    return scan_table(spark, path)


@query(PARTITIONED_EMAILS, name="publish_to_uri")
def published_dataset(spark, sf):
    return scan_table(spark, publish_to_uri(M.prepare_for_dataset(_emails(spark, sf)), scratch_dir(spark), "customer_care_emails"))


FIRST_THREADS = f"{_KEYED} FROM emails_dated WHERE {_NOT_DONE} QUALIFY row_number() OVER (PARTITION BY thread_id ORDER BY row_id) = 1"


@query(FIRST_THREADS, name="insert_if_absent")
def inserted_threads(spark, sf):
    """Three batches: the first rows, then rows that overlap them, then all again, which adds nothing."""
    ready, target = M.prepare_for_table(emails_in_order(spark, sf)), scratch_dir(spark)
    middle = ready.agg(F.percentile_approx("_row", 0.5)).first()[0]
    for batch in (ready.where(F.col("_row") <= middle), ready.where(F.col("_row") > middle * 0.8), ready):
        insert_if_absent(batch, target, ["thread_id"], ["_row"])
    return scan_table(spark, target)


@query("SELECT o_orderkey, o_totalprice, nullif(o_orderstatus, 'O') AS status FROM orders", name="insert_if_absent_partitioned")
def inserted_by_partition(spark, sf):
    """Batches that overlap, and all again, into a target laid out by a column with nulls."""
    target, rows = scratch_dir(spark), ("o_orderkey", "o_totalprice", "nullif(o_orderstatus, 'O') as status")
    orders = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(*rows)
    for part in ("o_orderkey % 3 > 0", "o_orderkey % 3 < 2", "true"):
        insert_if_absent(orders.where(part), target, ["o_orderkey"], ["o_totalprice"], partition="status")
    return scan_table(spark, target)


@query(FIRST_THREADS)
def ingest_emails_table(spark, sf):
    """The file is written in row order, so the first row of a thread in the file is its first row."""
    ordered = emails_in_order(spark, sf).orderBy("_row").drop("_row")
    target = scratch_dir(spark)
    path = _csv(ordered)
    for _ in range(2):
        M.ingest_emails_table(spark, path, target, multi_line=True)
    return scan_table(spark, target)


@query(PARTITIONED_EMAILS.replace("customer_satisfaction AS customer_satisfaction", "cast(customer_satisfaction AS varchar) AS customer_satisfaction"))
def ingest_emails_partitioned(spark, sf):
    return scan_table(spark, M.ingest_emails_partitioned(spark, _csv(_emails(spark, sf)), scratch_dir(spark), multi_line=True))


# --- contract rules -------------------------------------------------------------------------------------

RULE_SQL = {
    "not_null": [
        (c, f'"{c}" IS NULL') for c in M.EMAIL_COLUMNS
    ],
    "max_length": [
        ("subject", "length(subject) > 500"),
        ("sender", "length(sender) > 255"),
        ("receiver", "length(receiver) > 255"),
        ("message_body", "length(message_body) > 10000"),
    ],
    "email_format": [
        (c, f"NOT regexp_matches({c}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')") for c in ("sender", "receiver")
    ],
    "timestamp_format": [("timestamp", f'"timestamp" IS NOT NULL AND {_SENT} IS NULL')],
    "pattern": [
        (
            "thread_id",
            "NOT regexp_matches(thread_id, '^aa\\d{3}-[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}$')",
        )
    ],
    "array_allowed": [
        (
            c,
            f"len(list_filter(from_json({c}, '[\"VARCHAR\"]'), lambda x: x NOT IN ({', '.join(repr(v) for v in allowed)}))) > 0",
        )
        for c, allowed in (("email_types", M.EMAIL_TYPES), ("product_types", M.PRODUCT_TYPES))
    ],
    "allowed_values": [
        (c, f"{c} NOT IN ({', '.join(repr(v) for v in allowed)})")
        for c, allowed in (
            ("email_status", M.EMAIL_STATUS),
            ("email_criticality", M.CRITICALITY),
            ("agent_effectivity", M.RATING),
            ("agent_efficiency", M.RATING),
        )
    ],
    "range": [("customer_satisfaction", "customer_satisfaction NOT BETWEEN -1 AND 1")],
    "timestamp_in_past": [("timestamp", f"{_SENT} >= timestamp '2026-02-15 00:00:00'")],
    "non_blank": [("message_body", f"{_TRIM.format('message_body')} = ''")],
}


def _rule_sql(rule: str) -> str:
    return " UNION ALL ".join(
        f"(SELECT '{rule}' AS rule, '{column}' AS \"column\", violations, violations = 0 AS passed "
        f"FROM (SELECT count(*) FILTER (WHERE {broken}) AS violations FROM emails) AS v)"
        for column, broken in RULE_SQL[rule]
    )


def _register_rules() -> None:
    for rule in RULE_SQL:

        def run(spark, sf, rule=rule):
            rules = K.rule_predicates(M.DATASET_CONTRACT, [rule], AS_OF)
            return K.check_rules(EMAILS.spark(spark, sf), rules)

        query(_rule_sql(rule), name=f"contract_{rule}")(run)


_register_rules()


@query(
    "SELECT 'primary_key' AS rule, 'thread_id' AS \"column\", count(*) AS violations, count(*) = 0 AS passed "
    "FROM (SELECT 1 FROM emails GROUP BY thread_id HAVING count(*) > 1) AS g"
)
def contract_primary_key(spark, sf):
    return K.check_primary_key(EMAILS.spark(spark, sf), M.TABLE_CONTRACT.primary_key)


ALL_RULES_SQL = " UNION ALL ".join(_rule_sql(rule) for rule in RULE_SQL)


@query(ALL_RULES_SQL)
def contract_all_rules(spark, sf):
    return K.check_contract(EMAILS.spark(spark, sf), M.DATASET_CONTRACT, AS_OF)


# --- text functions -------------------------------------------------------------------------------------


@query(
    "SELECT row_id, from_json(email_types, '[\"VARCHAR\"]')[1] AS first_type, "
    "cast(len(from_json(email_types, '[\"VARCHAR\"]')) AS int) AS types FROM emails",
    name="parse_json_list",
)
def parse_json_list_text(spark, sf):
    types = parse_json_list(F.col("email_types"))
    return EMAILS.spark(spark, sf).select("row_id", F.get(types, 0).alias("first_type"), F.size(types).alias("types"))


@query("SELECT row_id, sha256('pepper' || lower(sender)) AS sender FROM emails", name="pseudonymize")
def pseudonymized_senders(spark, sf):
    return EMAILS.spark(spark, sf).select("row_id", pseudonymize(F.col("sender"), "pepper").alias("sender"))
