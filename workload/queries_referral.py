"""Referral report, its joins, rules and formatting: referrals made from orders, items, customers and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierloom.functions import (
    convert_utc_to_local,
    initcap_words,
    is_missing_string,
    norm_str,
    parse_bool,
    same_month,
    strip_timezone,
)
from tierloom.operators import cleaning as C
from tierloom.operators import dedupe as D
from tierloom.operators.aggregates import table_shapes
from tierloom.plans import referral as R
from tierloom.session import scratch_dir
from tierloom.sources.readers import scan_csv
from tierloom.sources.writers import write_report_csv
from workload.registry import query
from workload.shapes import HARD_SQL, LOGS, REFERRALS, TRANSACTIONS, USERS, referral_tables
from workload.sql import initcap, shown

RULE_NAMES = (
    "rule_reward_positive", "rule_status_success", "rule_transaction_exists", "rule_transaction_paid",
    "rule_transaction_new", "rule_transaction_after_referral", "rule_same_month", "rule_membership_active",
    "rule_referrer_not_deleted", "rule_reward_granted",
)


def clean(spark, sf, *names: str) -> dict[str, DataFrame]:
    tables = referral_tables(spark, sf)
    return R.clean_tables({n: tables[n] for n in names or tables})


def one(spark, sf, name: str) -> DataFrame:
    return clean(spark, sf, name)[name]


def wide(spark, sf) -> DataFrame:
    tables = referral_tables(spark, sf)
    return R.joined_report(R.clean_tables(tables), R.find_heavy(tables))


# --- cleaning -------------------------------------------------------------------------------------------


@query(
    "SELECT referral_id, trim(referee_name) AS referee_name, trim(referral_source) AS referral_source, "
    "trim(transaction_id) AS transaction_id FROM referrals"
)
def trim_strings(spark, sf):
    columns = ["referral_id", "referee_name", "referral_source", "transaction_id"]
    return C.trim_strings(REFERRALS.spark(spark, sf).select(columns))


_NA = "case o_orderkey % 5 when 0 then 'nan' when 1 then 'None' when 2 then 'NaN' when 3 then '' else o_orderpriority end"


@query(
    f"SELECT o_orderkey, case when word in ('nan', 'NaN', 'None', '') then null else word end AS word "
    f"FROM (SELECT o_orderkey, {_NA} AS word FROM orders) AS o"
)
def normalize_na_tokens(spark, sf):
    return C.normalize_na_tokens(spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey", f"{_NA} as word"))


_DATED = (
    "cast(o_orderdate as string) as created_at",
    "case when o_orderkey % 10 = 0 then 'never' else cast(o_orderdate as string) end as updated_on_date",
    "case when o_orderkey % 3 = 0 then 'soon' else cast(o_orderdate as string) end as expired",
    "o_orderpriority as time_slot",
    "cast(null as string) as last_timestamp",
)


@query(
    'SELECT unnest([\'created_at\', \'updated_on_date\', \'expired\', \'time_slot\', \'last_timestamp\']) AS "column", '
    "unnest([count(created_at), count(updated_on_date), count(expired), count(time_slot), 0]) AS non_null, "
    "unnest([count(try_cast(created_at AS timestamp)), count(try_cast(updated_on_date AS timestamp)), "
    "count(try_cast(expired AS timestamp)), 0, 0]) AS parsed, unnest([true, true, false, false, false]) AS is_datetime "
    f"FROM (SELECT {', '.join(_DATED)} FROM orders) AS o"
)
def infer_datetime_columns(spark, sf):
    return C.datetime_evidence(spark.read.parquet(f"{sf}/orders.parquet").selectExpr(*_DATED))


@query(
    f"SELECT o_orderkey, try_cast(updated_on_date AS timestamp) AS updated_on_date, try_cast(expired AS timestamp) AS expired "
    f"FROM (SELECT o_orderkey, {', '.join(_DATED)} FROM orders) AS o"
)
def cast_datetimes(spark, sf):
    texts = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey", *_DATED)
    return C.cast_datetimes(texts.select("o_orderkey", "updated_on_date", "expired"), ["updated_on_date", "expired"])


@query("SELECT * FROM referrals WHERE referrer_id IS NOT NULL AND transaction_id IS NOT NULL")
def require_keys(spark, sf):
    return C.require_keys(REFERRALS.spark(spark, sf), ["referrer_id", "transaction_id"])


_AMOUNT = "case o_orderkey % 4 when 0 then cast(o_totalprice as string) when 1 then '10 days' when 2 then ' 7 ' end"


@query(f"SELECT o_orderkey, coalesce(try_cast(trim({_AMOUNT}) AS double), 0) AS amount FROM orders")
def coerce_numeric(spark, sf):
    return C.coerce_numeric(spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey", f"{_AMOUNT} as amount"), ["amount"])


_GAPS = (
    "case when o_orderkey % 2 = 0 then o_orderdate end as placed_at",
    "case when o_orderkey % 3 = 0 then o_totalprice end as price",
    "case when o_orderkey % 5 = 0 then o_orderpriority end as priority",
    "case when o_orderkey % 7 = 0 then o_orderstatus = 'O' end as is_open",
)


@query(
    "SELECT o_orderkey, coalesce(placed_at, timestamp '1970-01-01 00:00:00') AS placed_at, coalesce(price, 0) AS price, "
    "coalesce(priority, '') AS priority, coalesce(is_open, false) AS is_open "
    f"FROM (SELECT o_orderkey, {', '.join(_GAPS)} FROM orders) AS o"
)
def fill_nulls_by_type(spark, sf):
    return C.fill_nulls_by_type(spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey", *_GAPS))


@query(
    "SELECT unnest(['o_orderkey', 'placed_at', 'price', 'priority', 'is_open']) AS \"column\", unnest([count(*) - count(o_orderkey), "
    "count(*) - count(placed_at), count(*) - count(price), count(*) - count(priority), count(*) - count(is_open)]) AS null_count "
    f"FROM (SELECT o_orderkey, {', '.join(_GAPS)} FROM orders) AS o"
)
def assert_no_nulls(spark, sf):
    """Counts of the gaps, after the filled table has passed."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey", *_GAPS)
    C.assert_no_nulls(C.fill_nulls_by_type(orders), "orders")
    return C.null_counts(orders)


@query("SELECT * FROM c_referrals")
def clean_table(spark, sf):
    return one(spark, sf, "user_referrals")


# --- one row per key ------------------------------------------------------------------------------------


@query("SELECT * FROM latest_logs")
def latest_log_per_referral(spark, sf):
    return D.latest_log_per_referral(one(spark, sf, "user_referral_logs"))


@query("SELECT * FROM latest_users")
def latest_user_record(spark, sf):
    return D.latest_user_record(one(spark, sf, "user_logs"))


@query("SELECT * FROM latest_leads")
def latest_lead_record(spark, sf):
    return D.latest_lead_record(one(spark, sf, "lead_logs"))


@query("SELECT * FROM zones")
def last_value_lookup(spark, sf):
    return R.user_zones(one(spark, sf, "user_logs"))


# --- time zones -----------------------------------------------------------------------------------------


@query("SELECT * FROM l_users")
def utc_to_local(spark, sf):
    return convert_utc_to_local(one(spark, sf, "user_logs"), ["membership_expired_date"], "timezone_homeclub")


@query("SELECT * FROM zoned_referrals")
def lookup_referral_timezone(spark, sf):
    tables = clean(spark, sf, "user_referrals", "user_logs")
    return R.lookup_referral_timezone(tables["user_referrals"], tables["user_logs"])


@query("SELECT * FROM zoned_logs")
def lookup_two_hop_timezone(spark, sf):
    tables = clean(spark, sf, "user_referral_logs", "user_referrals", "user_logs")
    return R.lookup_two_hop_timezone(tables["user_referral_logs"], tables["user_referrals"], tables["user_logs"])


_LOCAL = {
    "lead_logs": ("l_leads", "cast(id AS varchar)", "created_at"),
    "user_logs": ("l_users", "cast(id AS varchar)", "membership_expired_date"),
    "paid_transactions": ("l_transactions", "transaction_id", "transaction_at"),
    "user_referrals": ("l_referrals", "referral_id", "referral_at"),
    "user_referral_logs": ("l_logs", "cast(id AS varchar)", "created_at"),
    "user_referral_statuses": ("statuses", "cast(id AS varchar)", "created_at"),
    "referral_rewards": ("rewards", "cast(id AS varchar)", "created_at"),
}


_LOCAL_SQL = " UNION ALL ".join(
    f"(SELECT '{name}' AS \"table\", {key} AS row_key, {ts} AS local_time FROM {block})"
    for name, (block, key, ts) in _LOCAL.items()
)

# A key with more rows than this is spread in the queries on hard tables.
SPREAD = 20


@query(_LOCAL_SQL)
def apply_timezones(spark, sf):
    raw = referral_tables(spark, sf)
    return _local_times(R.apply_timezones(R.clean_tables(raw), R.find_heavy(raw)))


@query(_LOCAL_SQL, other=HARD_SQL)
def apply_timezones_spread(spark, sf):
    raw = referral_tables(spark, sf, hard=True)
    return _local_times(R.apply_timezones(R.clean_tables(raw), R.find_heavy(raw, SPREAD)))


def _local_times(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, (_, key, ts) in _LOCAL.items():
        row_key = F.expr(key.replace("varchar", "string"))
        part = tables[name].select(F.lit(name).alias("table"), row_key.alias("row_key"), F.col(ts).alias("local_time"))
        out = part if out is None else out.unionByName(part)
    return out


# --- joins ----------------------------------------------------------------------------------------------

_BASE = "r.referral_id"


def _base(spark, sf, *others: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    tables = clean(spark, sf, "user_referrals", *others)
    return tables["user_referrals"].distinct(), tables


@query(
    f"SELECT {_BASE}, g.id, g.created_at, g.is_reward_granted FROM c_referrals r "
    "LEFT JOIN latest_logs g ON r.referral_id = g.user_referral_id"
)
def join_referral_logs(spark, sf):
    base, tables = _base(spark, sf, "user_referral_logs")
    joined = R.join_referral_logs(base, tables["user_referral_logs"])
    return joined.select("referral_id", "id", "created_at", "is_reward_granted")


@query(
    f"SELECT {_BASE}, s.description, s.created_at AS created_at_status FROM c_referrals r "
    "LEFT JOIN statuses s ON r.user_referral_status_id = s.id"
)
def join_statuses(spark, sf):
    base, tables = _base(spark, sf, "user_referral_statuses")
    return R.join_statuses(base, tables["user_referral_statuses"]).select("referral_id", "description", "created_at_status")


@query(
    f"SELECT {_BASE}, w.reward_value, w.reward_type FROM c_referrals r LEFT JOIN c_rewards w ON r.referral_reward_id = w.id"
)
def join_rewards(spark, sf):
    base, tables = _base(spark, sf, "referral_rewards")
    return R.join_rewards(base, tables["referral_rewards"]).select("referral_id", "reward_value", "reward_type")


@query(
    f"SELECT {_BASE}, r.transaction_id, t.transaction_status, t.transaction_at, t.transaction_type FROM c_referrals r "
    "LEFT JOIN c_transactions t ON r.transaction_id = t.transaction_id"
)
def join_transactions(spark, sf):
    base, tables = _base(spark, sf, "paid_transactions")
    joined = R.join_transactions(base, tables["paid_transactions"])
    return joined.select("referral_id", "transaction_id", "transaction_status", "transaction_at", "transaction_type")


@query(
    f"SELECT {_BASE}, u.id AS id_referrer, u.name AS name_referrer, u.membership_expired_date AS membership_expired_date_referrer "
    "FROM c_referrals r LEFT JOIN latest_users u ON r.referrer_id = u.user_id"
)
def join_referrer(spark, sf):
    base, tables = _base(spark, sf, "user_logs")
    joined = R.join_referrer(base, D.latest_user_record(tables["user_logs"]))
    return joined.select("referral_id", "id_referrer", "name_referrer", "membership_expired_date_referrer")


@query(
    f"SELECT {_BASE}, u.id AS id_referee, u.homeclub AS homeclub_referee, u.is_deleted AS is_deleted_referee "
    "FROM c_referrals r LEFT JOIN latest_users u ON r.referee_id = u.user_id"
)
def join_referee(spark, sf):
    base, tables = _base(spark, sf, "user_logs")
    joined = R.join_referee(base, D.latest_user_record(tables["user_logs"]))
    return joined.select("referral_id", "id_referee", "homeclub_referee", "is_deleted_referee")


@query(
    f"SELECT {_BASE}, d.lead_id, d.source_category, d.created_at AS created_at_lead, d.current_status "
    "FROM c_referrals r LEFT JOIN latest_leads d ON r.referee_id = d.lead_id"
)
def join_leads(spark, sf):
    base, tables = _base(spark, sf, "lead_logs")
    joined = R.join_leads(base, tables["lead_logs"])
    return joined.select("referral_id", "lead_id", "source_category", "created_at_lead", "current_status")


@query("SELECT * FROM wide")
def build_final_dataset(spark, sf):
    tables = referral_tables(spark, sf)
    heavy = R.find_heavy(tables)
    return R.build_final_dataset(R.apply_timezones(R.clean_tables(tables), heavy), heavy)


@query("SELECT * FROM wide", other=HARD_SQL)
def build_final_dataset_spread(spark, sf):
    tables = referral_tables(spark, sf, hard=True)
    heavy = R.find_heavy(tables, SPREAD)
    return R.build_final_dataset(R.apply_timezones(R.clean_tables(tables), heavy), heavy)


def _cardinality_sql() -> str:
    steps = [
        ("user_referral_logs", "LEFT JOIN latest_logs j1 ON r.referral_id = j1.user_referral_id"),
        ("user_referral_statuses", "LEFT JOIN statuses j2 ON r.user_referral_status_id = j2.id"),
        ("referral_rewards", "LEFT JOIN c_rewards j3 ON r.referral_reward_id = j3.id"),
        ("paid_transactions", "LEFT JOIN c_transactions j4 ON r.transaction_id = j4.transaction_id"),
        ("user_logs_referrer", "LEFT JOIN latest_users j5 ON r.referrer_id = j5.user_id"),
        ("user_logs_referee", "LEFT JOIN latest_users j6 ON r.referee_id = j6.user_id"),
        ("lead_logs", "LEFT JOIN latest_leads j7 ON r.referee_id = j7.lead_id"),
    ]
    parts = []
    for i, (name, _) in enumerate(steps):
        before = " ".join(join for _, join in steps[:i])
        after = " ".join(join for _, join in steps[: i + 1])
        parts.append(
            f"(SELECT cast({i + 1} AS int) AS step, '{name}' AS \"join\", "
            f"(SELECT count(*) FROM c_referrals r {before}) AS rows_before, "
            f"(SELECT count(*) FROM c_referrals r {after}) AS rows_after)"
        )
    return " UNION ALL ".join(parts)


@query(_cardinality_sql())
def join_cardinality_check(spark, sf):
    tables = referral_tables(spark, sf)
    return R.join_cardinality_check(R.clean_tables(tables), R.find_heavy(tables))


@query("SELECT * FROM wide")
def drop_join_id_columns(spark, sf):
    extra = {c: F.lit(1) for c in ("id_status", "id_reward", "id_lead")}
    return R.drop_join_id_columns(wide(spark, sf).withColumns(extra))


@query(
    "SELECT id AS id_referrer, user_id, name AS name_referrer, phone_number AS phone_number_referrer, homeclub AS homeclub_referrer, "
    "timezone_homeclub AS timezone_homeclub_referrer, membership_expired_date AS membership_expired_date_referrer, "
    "is_deleted AS is_deleted_referrer FROM latest_users"
)
def rename_with_suffix(spark, sf):
    return R.with_suffix(D.latest_user_record(one(spark, sf, "user_logs")), "_referrer", keep=["user_id"])


@query("SELECT DISTINCT referee_id, referee_phone, referral_source, user_referral_status_id FROM c_referrals")
def distinct_rows(spark, sf):
    columns = ["referee_id", "referee_phone", "referral_source", "user_referral_status_id"]
    return one(spark, sf, "user_referrals").select(columns).distinct()


@query("SELECT count(*) - count(DISTINCT user_referral_id) AS duplicates FROM c_logs")
def duplicate_id_count(spark, sf):
    return R.duplicate_id_count(one(spark, sf, "user_referral_logs"), "user_referral_id")


@query(
    "SELECT * FROM (SELECT 'user_referrals' AS \"table\", count(*) AS row_count, cast(11 AS int) AS column_count FROM c_referrals "
    "UNION ALL SELECT 'user_referral_logs', count(*), 5 FROM c_logs UNION ALL SELECT 'user_logs', count(*), 8 FROM c_users "
    "UNION ALL SELECT 'paid_transactions', count(*), 6 FROM c_transactions UNION ALL SELECT 'lead_logs', count(*), 7 FROM c_leads "
    "UNION ALL SELECT 'user_referral_statuses', count(*), 3 FROM statuses "
    "UNION ALL SELECT 'referral_rewards', count(*), 4 FROM c_rewards) AS shapes",
    name="table_shapes",
)
def referral_table_shapes(spark, sf):
    return table_shapes(clean(spark, sf))


@query(
    "SELECT 'referral_report' AS \"check\", (SELECT count(*) FROM orders) AS expected, count(*) AS observed, "
    "count(*) = (SELECT count(*) FROM orders) AS passed FROM report"
)
def expect_row_count(spark, sf):
    expected = spark.read.parquet(f"{sf}/orders.parquet").count()
    report = R.expect_row_count(R.referral_report(referral_tables(spark, sf)), expected)
    count = report.agg(F.count("*").alias("observed"))
    expected = F.lit(expected).cast("long")
    return count.select(F.lit("referral_report").alias("check"), expected.alias("expected"), "observed", (F.col("observed") == expected).alias("passed"))


# --- rules ----------------------------------------------------------------------------------------------


@query("SELECT referral_id, referral_source_category FROM categorized")
def source_category_case(spark, sf):
    return R.derive_source_category(wide(spark, sf)).select("referral_id", "referral_source_category")


@query("SELECT referral_id, " + ", ".join(RULE_NAMES) + ", is_business_logic_valid FROM judged")
def business_rules(spark, sf):
    return R.business_rules(wide(spark, sf)).select("referral_id", *RULE_NAMES, "is_business_logic_valid")


def _register_rules() -> None:
    for rule in (*RULE_NAMES, "is_business_logic_valid"):

        def run(spark, sf, rule=rule):
            return R.business_rules(wide(spark, sf)).select("referral_id", rule)

        query(f"SELECT referral_id, {rule} FROM judged", name=rule)(run)


_register_rules()


@query(
    "SELECT referral_id, is_business_logic_valid, reward_value, description, transaction_status, transaction_type, "
    "is_reward_granted, is_deleted_referrer FROM judged WHERE referral_id = (SELECT max(referral_id) FROM c_referrals)"
)
def spot_check_row(spark, sf):
    """What the rules of one report row look at: the row with the last referral id."""
    inputs = ["reward_value", "description", "transaction_status", "transaction_type", "is_reward_granted", "is_deleted_referrer"]
    last = one(spark, sf, "user_referrals").agg(F.max("referral_id")).first()[0]
    return R.report_row(R.validate(wide(spark, sf)), last).select("referral_id", "is_business_logic_valid", *inputs)


# --- text and values ------------------------------------------------------------------------------------


@query(
    "SELECT o_orderkey, year(o_orderdate) = year(t) AND month(o_orderdate) = month(t) AS same_month "
    "FROM (SELECT *, o_orderdate + interval 29 hour AS t FROM orders) AS o",
    name="same_month",
)
def same_month_of_order(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    later = F.col("o_orderdate") + F.expr("interval 29 hour")
    return orders.select("o_orderkey", same_month(F.col("o_orderdate"), later).alias("same_month"))


@query(f"SELECT id, {initcap('name')} AS name FROM users", name="initcap_words")
def initcap_user_names(spark, sf):
    return USERS.spark(spark, sf).select("id", initcap_words(F.col("name")).alias("name"))


_WORD = "case l_linenumber when 1 then null when 2 then ' ' when 3 then 'NaN' when 4 then 'None ' when 5 then '<NA>' else l_linestatus end"


@query(
    f"SELECT word, word IS NULL OR lower(trim(word)) IN ('', '<na>', 'nan', 'none') AS missing, count(*) AS rows "
    f"FROM (SELECT {_WORD} AS word FROM lineitem) AS w GROUP BY ALL",
    name="is_missing_string",
)
def missing_words(spark, sf):
    words = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(f"{_WORD} as word")
    return words.withColumn("missing", is_missing_string(F.col("word"))).groupBy("word", "missing").agg(F.count("*").alias("rows"))


@query(
    "SELECT id, lower(trim(is_reward_granted)) IN ('true', '1', 'yes', 'y') AS granted FROM logs",
    name="parse_bool",
)
def parse_granted(spark, sf):
    return LOGS.spark(spark, sf).select("id", parse_bool(F.col("is_reward_granted")).alias("granted"))


@query("SELECT transaction_id, lower(trim(transaction_location)) AS location FROM transactions", name="norm_str")
def norm_location(spark, sf):
    return TRANSACTIONS.spark(spark, sf).select("transaction_id", norm_str(F.col("transaction_location")).alias("location"))


@query(
    f"SELECT transaction_id, {shown('transaction_status')} AS transaction_status, transaction_at, "
    f"{shown('transaction_location')} AS transaction_location, timezone_transaction, "
    f"{shown('transaction_type')} AS transaction_type FROM c_transactions"
)
def format_strings(spark, sf):
    return R.format_strings(one(spark, sf, "paid_transactions"))


@query(
    "SELECT transaction_id, upper(transaction_status[1]) || lower(transaction_status[2:]) AS transaction_status, "
    "upper(transaction_type[1]) || lower(transaction_type[2:]) AS transaction_type FROM c_transactions"
)
def normalize_enums(spark, sf):
    columns = ["transaction_id", "transaction_status", "transaction_type"]
    return R.normalize_enums(one(spark, sf, "paid_transactions").select(columns))


@query("SELECT event_id, ts AS wall_clock FROM events", name="strip_timezone")
def strip_event_timezone(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select("event_id", strip_timezone(F.col("ts").cast("timestamp")).alias("wall_clock"))


# --- report ---------------------------------------------------------------------------------------------


@query("SELECT " + ", ".join(R.REPORT_COLUMNS) + " FROM judged")
def select_report_columns(spark, sf):
    return R.select_report_columns(R.validate(R.derive_source_category(wide(spark, sf))))


@query(
    "SELECT referral_id, coalesce(transaction_at, timestamp '1970-01-01 00:00:00') AS transaction_at, "
    "coalesce(reward_value, 0) AS reward_value, case when trim(coalesce(homeclub_referee, '')) = '' then 'UNKNOWN' "
    "else homeclub_referee end AS homeclub_referee, case when trim(coalesce(referee_name, '')) = '' then 'Unknown' "
    "else referee_name end AS referee_name, coalesce(is_deleted_referee, false) AS is_deleted_referee FROM wide"
)
def finalize_fill(spark, sf):
    columns = ["referral_id", "transaction_at", "reward_value", "homeclub_referee", "referee_name", "is_deleted_referee"]
    return R.finalize_fill(wide(spark, sf).select(columns))


@query("SELECT * FROM report")
def referral_report(spark, sf):
    return R.referral_report(referral_tables(spark, sf))


@query("SELECT * FROM report", other=HARD_SQL)
def referral_report_spread(spark, sf):
    return R.referral_report(referral_tables(spark, sf, hard=True), rows_per_task=SPREAD)


@query("SELECT * FROM report ORDER BY referral_id LIMIT 5")
def preview(spark, sf):
    return R.preview(R.referral_report(referral_tables(spark, sf)))


@query("SELECT * FROM report", name="write_report_csv")
def written_report(spark, sf):
    report = R.referral_report(referral_tables(spark, sf))
    path = write_report_csv(report, scratch_dir(spark))
    return scan_csv(spark, path, report.schema, na_tokens=())


@query("SELECT * FROM c_users", name="scan_csv")
def scan_written_csv(spark, sf):
    path = write_report_csv(one(spark, sf, "user_logs"), scratch_dir(spark))
    schema = one(spark, sf, "user_logs").schema
    return scan_csv(spark, path, schema)
