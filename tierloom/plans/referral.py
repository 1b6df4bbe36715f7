"""Referral report: clean, shift to local time, join seven tables, judge each referral, format.

Row order of operations and the words shown for missing values follow the report's contract; the joins
are ordered so that the wide referral rows are shuffled as few times as possible.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierloom.functions import (
    coalesce_false,
    convert_utc_to_local,
    initcap_words,
    is_missing_string,
    leading_number,
    norm_str,
    normalize_na,
    parse_bool,
    same_month,
    single_spaced,
    strip_ws,
    to_number,
    typed_default,
)
from tierloom.functions.strings import MISSING_WORDS
from tierloom.operators.cleaning import clean_table, snake_case_columns
from tierloom.operators.dedupe import (
    best_per_key,
    last_value_lookup,
    latest_lead_record,
    latest_log_per_referral,
    latest_user_record,
)
from tierloom.operators.joins import (
    ROWS_PER_TASK,
    dimension_join,
    heavy_keys_of,
    join_cardinality,
    left_join,
    measured,
    with_suffix,
)
from tierloom.sources.readers import scan_csv
from tierloom.sources.writers import stored

Tables = Mapping[str, DataFrame]

# Columns and types of the seven input files.
SCHEMAS = {
    "lead_logs": "id int, lead_id string, source_category string, created_at timestamp, "
    "preferred_location string, timezone_location string, current_status string",
    "user_referrals": "referral_at timestamp, referral_id string, referee_id string, referee_name string, "
    "referee_phone string, referral_reward_id int, referral_source string, referrer_id string, "
    "transaction_id string, updated_at timestamp, user_referral_status_id int",
    "user_referral_logs": "id int, user_referral_id string, source_transaction_id string, "
    "created_at timestamp, is_reward_granted boolean",
    "user_logs": "id int, user_id string, name string, phone_number string, homeclub string, "
    "timezone_homeclub string, membership_expired_date timestamp, is_deleted boolean",
    "user_referral_statuses": "id int, description string, created_at timestamp",
    "referral_rewards": "id int, reward_value string, created_at timestamp, reward_type int",
    "paid_transactions": "transaction_id string, transaction_status string, transaction_at timestamp, "
    "transaction_location string, timezone_transaction string, transaction_type string",
}

# Keys a row of each table must have.
REQUIRED_KEYS = {
    "lead_logs": ["id", "lead_id"],
    "user_referrals": ["referral_id"],
    "user_referral_logs": ["id", "user_referral_id"],
    "user_logs": ["id", "user_id"],
    "user_referral_statuses": ["id"],
    "referral_rewards": ["id"],
    "paid_transactions": ["transaction_id"],
}

# Date columns, declared so that cleaning needs no job to find them.
DATETIMES = {
    "lead_logs": ["created_at"],
    "user_referrals": ["referral_at", "updated_at"],
    "user_referral_logs": ["created_at"],
    "user_logs": ["membership_expired_date"],
    "user_referral_statuses": ["created_at"],
    "referral_rewards": ["created_at"],
    "paid_transactions": ["transaction_at"],
}

# Zone column of the tables that carry their own.
ZONE_COLUMNS = {
    "lead_logs": "timezone_location",
    "user_logs": "timezone_homeclub",
    "paid_transactions": "timezone_transaction",
}

# Report columns in order.
REPORT_COLUMNS = (
    "referral_id", "referral_at", "referral_source", "referral_source_category", "user_referral_status_id",
    "description", "referral_reward_id", "reward_type", "reward_value", "is_reward_granted", "transaction_id",
    "transaction_status", "transaction_type", "transaction_at", "transaction_location", "referrer_id",
    "name_referrer", "phone_number_referrer", "homeclub_referrer", "membership_expired_date_referrer",
    "is_deleted_referrer", "referee_id", "referee_name", "referee_phone", "homeclub_referee",
    "membership_expired_date_referee", "is_deleted_referee", "source_category", "preferred_location",
    "current_status", "is_business_logic_valid",
)

# Name parts of columns whose text is shown as it is, and of club names.
AS_IS_PARTS = ("_id", "timezone", "phone")
CLUB_PART = "club"

# Report columns with a fixed type whatever the data: numbers as double, joined flags as words.
DOUBLE_COLUMNS = ("referral_reward_id", "reward_type", "reward_value")
FLAG_COLUMNS = ("is_reward_granted", "is_deleted_referrer", "is_deleted_referee")

# Endings of join id columns the report drops.
ID_ENDINGS = ("_status", "_reward", "_transaction", "_lead", "_log")

LATEST_LOG = "wall_clock"


# --- inputs -------------------------------------------------------------------------------------------


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven CSV files of a folder, typed."""
    return {
        name: scan_csv(spark, f"{folder.rstrip('/')}/{name}.csv", T.StructType.fromDDL(ddl))
        for name, ddl in SCHEMAS.items()
    }


def clean_tables(tables: Tables, reward_parse=to_number) -> dict[str, DataFrame]:
    """Every table cleaned. Rewards such as ``10 days`` are no numbers and become 0; pass
    ``leading_number`` to read the number in front."""
    return {
        name: clean_table(
            df,
            keys=REQUIRED_KEYS.get(name, ()),
            numeric=["reward_value"] if name == "referral_rewards" else (),
            datetimes=DATETIMES.get(name),
            parse_numeric=reward_parse,
        )
        for name, df in tables.items()
    }


REWARD_PARSERS = {"number": to_number, "leading_number": leading_number}


# --- local time ---------------------------------------------------------------------------------------


def _timestamps(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]


def _own_zone(name: str, df: DataFrame) -> DataFrame:
    return convert_utc_to_local(df, _timestamps(df), ZONE_COLUMNS[name])


def user_zones(users: DataFrame) -> DataFrame:
    """Zone per user; the last row of a user wins."""
    return last_value_lookup(users, "user_id", "timezone_homeclub", [F.desc("id")])


def few_copies(heavy: Mapping | None) -> bool:
    """True if no referral id is heavy, so that no referral row has many copies. Not known without an entry."""
    return heavy is not None and heavy.get("referral_id") == {}


def _zone_of(df: DataFrame, zones: DataFrame, key: str, name: str, heavy: Mapping | None, repeated: bool) -> DataFrame:
    named = zones.toDF("_zone_user", name)
    return left_join(df, named, key, "_zone_user", heavy, repeated=repeated).drop("_zone_user")


def lookup_referral_timezone(referrals: DataFrame, users: DataFrame, heavy: Mapping | None = None) -> DataFrame:
    """Referrals with ``timezone``: the referrer's zone, else the referee's."""
    zones, repeated = user_zones(users), not few_copies(heavy)
    # The referrer comes last, as it is what the report joins on next: that join then reuses this shuffle.
    out = _zone_of(referrals, zones, "referee_id", "timezone_referee", (heavy or {}).get("referee_id"), repeated)
    out = _zone_of(out, zones, "referrer_id", "timezone_referrer", (heavy or {}).get("referrer_id"), repeated)
    zone = F.coalesce("timezone_referrer", "timezone_referee").alias("timezone")
    return out.select(*referrals.columns, "timezone_referrer", "timezone_referee", zone)


def lookup_two_hop_timezone(
    logs: DataFrame, referrals: DataFrame, users: DataFrame, heavy: Mapping | None = None
) -> DataFrame:
    """Logs with ``timezone_homeclub``: log to referral, referral to referrer, referrer to zone."""
    heavy = heavy or {}
    newest = [F.desc("updated_at"), F.desc("referral_at"), F.desc("referrer_id")]
    referrers = best_per_key(referrals, ["referral_id"], newest).select("referral_id", "referrer_id")
    # One row per referral, so there are no copies to merge.
    zones = _zone_of(referrers, user_zones(users), "referrer_id", "timezone_homeclub", heavy.get("referrer_id"), False)
    hop = zones.select(F.col("referral_id").alias("_hop"), "timezone_homeclub")
    return left_join(logs, hop, "user_referral_id", "_hop", heavy.get("user_referral_id"), repeated=True).drop("_hop")


def _local_logs(logs: DataFrame, referrals: DataFrame, users: DataFrame, heavy: Mapping | None) -> DataFrame:
    zoned = lookup_two_hop_timezone(logs, referrals, users, heavy)
    return convert_utc_to_local(zoned, _timestamps(logs), "timezone_homeclub").drop("timezone_homeclub")


def apply_timezones(tables: Tables, heavy: Mapping | None = None) -> dict[str, DataFrame]:
    """Every timestamp of five tables shifted to local time; statuses and rewards stay in UTC."""
    out = dict(tables)
    for name in ZONE_COLUMNS:
        if name in tables:
            out[name] = _own_zone(name, tables[name])
    if "user_referrals" in tables and "user_logs" in tables:
        referrals = tables["user_referrals"]
        zoned = lookup_referral_timezone(referrals, tables["user_logs"], heavy)
        out["user_referrals"] = convert_utc_to_local(zoned, _timestamps(referrals), "timezone").select(referrals.columns)
        if "user_referral_logs" in tables:
            out["user_referral_logs"] = _local_logs(
                tables["user_referral_logs"], referrals, tables["user_logs"], heavy
            )
    return out


# --- joins --------------------------------------------------------------------------------------------


def _rename(df: DataFrame, suffix: str) -> DataFrame:
    """Suffix on the two column names several tables share."""
    return df.withColumnsRenamed({c: c + suffix for c in ("id", "created_at")})


def join_referral_logs(base: DataFrame, logs: DataFrame, heavy: Mapping | None = None) -> DataFrame:
    """Newest log of each referral."""
    latest = latest_log_per_referral(logs)
    return left_join(base, latest, "referral_id", "user_referral_id", (heavy or {}).get("referral_id"))


def join_statuses(base: DataFrame, statuses: DataFrame, referrals: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """``referrals`` is a narrow table with the keys of ``base``, read only if statuses are too many to broadcast."""
    return dimension_join(base, _rename(statuses, "_status"), "user_referral_status_id", "id_status", referrals, small=small)


def join_rewards(base: DataFrame, rewards: DataFrame, referrals: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    return dimension_join(base, _rename(rewards, "_reward"), "referral_reward_id", "id_reward", referrals, small=small)


def join_transactions(base: DataFrame, transactions: DataFrame, heavy: Mapping | None = None) -> DataFrame:
    right, heavy = transactions.withColumnRenamed("transaction_id", "_paid_id"), heavy or {}
    spread = heavy.get("transaction_id"), heavy.get(PAID_ID)
    # Without heavy ids no row has many copies, so they need not be merged before the shuffle of the join.
    few = heavy.get(PAID_ID) == {}
    right = right if few else right.distinct()
    return left_join(base, right, "transaction_id", "_paid_id", *spread, distinct_right=few).drop("_paid_id")


def join_referrer(base: DataFrame, user_rows: DataFrame, heavy: Mapping | None = None, distinct: bool = False) -> DataFrame:
    """``user_rows`` holds one row per user. ``distinct`` removes copies of base rows, in the shuffle of the join if
    there are few."""
    right, few = with_suffix(user_rows, "_referrer"), few_copies(heavy)
    base = base.distinct() if distinct and not few else base
    spread = (heavy or {}).get("referrer_id")
    out = left_join(base, right, "referrer_id", "user_id_referrer", spread, distinct_left=distinct and few)
    return out.drop("user_id_referrer")


def join_referee(base: DataFrame, user_rows: DataFrame, heavy: Mapping | None = None) -> DataFrame:
    right = with_suffix(user_rows, "_referee")
    out = left_join(base, right, "referee_id", "user_id_referee", (heavy or {}).get("referee_id"))
    return out.drop("user_id_referee")


def join_leads(base: DataFrame, leads: DataFrame, heavy: Mapping | None = None) -> DataFrame:
    """Newest row of the lead the referee came from."""
    named = _rename(latest_lead_record(leads), "_lead")
    return left_join(base, named, "referee_id", "lead_id", (heavy or {}).get("referee_id"))


def drop_join_id_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("id") and c.endswith(ID_ENDINGS)])


JOIN_KEYS = ("referrer_id", "referee_id", "transaction_id", "referral_id")

# Entry for heavy keys on the transactions' side, the one right side that may repeat its key.
PAID_ID = "paid_transactions.transaction_id"

# Tables that may have heavy keys, and the columns they are joined on.
KEY_COLUMNS = {"user_referrals": JOIN_KEYS, "user_referral_logs": ("user_referral_id",), "paid_transactions": ("transaction_id",)}


# Entry for the row counts of these tables, and the rows in all beyond which a report is made in two steps.
ROWS = "rows"
STAGED_ROWS = 10_000_000

# Tables that are looked up if they are small.
DIMENSIONS = ("user_referral_statuses", "referral_rewards")


def find_heavy(raw: Tables, rows: int = ROWS_PER_TASK, counts: Mapping[str, int] | None = None) -> dict[str, dict]:
    """Heavy keys of the report's shuffle joins, read from the raw key columns of three tables in one job, and row counts.

    Tables that ``counts`` says have no more than ``rows`` rows are not read; they are counted if it is not given.
    """
    counts = measured({name: raw[name] for name in KEY_COLUMNS})[0] if counts is None else counts

    def keys(name: str, columns: Sequence[str]) -> DataFrame:
        text = {c: normalize_na(strip_ws(F.col(c).cast("string"))) for c in columns}
        return snake_case_columns(raw[name]).select(*[F.coalesce(t, F.lit("")).alias(c) for c, t in text.items()])

    found = heavy_keys_of({name: keys(name, columns) for name, columns in KEY_COLUMNS.items()}, rows, counts)
    paid = {PAID_ID: found["paid_transactions"]["transaction_id"], ROWS: dict(counts)}
    return found["user_referrals"] | found["user_referral_logs"] | paid


def is_staged(heavy: Mapping | None) -> bool:
    """True if the tables of a report are known to be large."""
    return sum((heavy or {}).get(ROWS, {}).values()) > STAGED_ROWS


def survey(raw: Tables, rows: int = ROWS_PER_TASK) -> tuple[dict[str, dict], dict[str, bool]]:
    """Heavy keys, and which dimensions are small: one job for sizes, and one for keys if a table is large enough to have any."""
    counts, small = measured({name: raw[name] for name in KEY_COLUMNS}, {name: raw[name] for name in DIMENSIONS})
    return find_heavy(raw, rows, counts), small


def _join_details(
    base: DataFrame,
    tables: Tables,
    heavy: Mapping | None,
    small: Mapping[str, bool] | None = None,
    staged: bool = False,
    needed: Sequence[str] = (),
) -> DataFrame:
    """Leads, transactions, logs and the two small tables, for referrals that have their users.

    Leads come first: they join on the key the referee was just joined on, so that shuffle is reused. Transactions are
    the one right side that may repeat its key. Unless no id is known to be heavy there, they come after the logs, so
    that the rows they multiply are not shuffled. ``staged`` stores the table before the last of these joins, with
    the ``needed`` columns if some are named: else disks hold the shuffle files of all joins at once.
    """
    joins = [lambda df: join_transactions(df, tables["paid_transactions"], heavy), lambda df: join_referral_logs(df, tables["user_referral_logs"], heavy)]
    logs_first = (heavy or {}).get(PAID_ID) != {}
    led = join_leads(base, tables["lead_logs"], heavy)
    half = joins[logs_first](led)
    if staged:
        half = stored(half.select(*[c for c in half.columns if c in needed]) if needed else half)
    out = joins[not logs_first](half)
    if logs_first:
        in_led = [c for c in half.columns if c in led.columns]
        out = out.select(*in_led, *out.columns[len(half.columns):], *half.columns[len(in_led):])
    if small is None:
        small = measured({}, {name: tables[name] for name in DIMENSIONS})[1]
    out = join_statuses(out, tables["user_referral_statuses"], tables["user_referrals"], small["user_referral_statuses"])
    return join_rewards(out, tables["referral_rewards"], tables["user_referrals"], small["referral_rewards"])


def build_final_dataset(tables: Tables, heavy: Mapping | None = None) -> DataFrame:
    """Local-time tables joined to one wide table, one row per distinct referral row.

    Distinct left rows joined to distinct right rows stay distinct, so repeated rows are removed from
    the narrow inputs and never from the wide result: in the shuffle of their first join, or before it if
    there may be many copies of a row. Tables that ``heavy`` says are large are joined in two steps.
    """
    users = latest_user_record(tables["user_logs"])
    out = join_referee(join_referrer(tables["user_referrals"], users, heavy, distinct=True), users, heavy)
    return drop_join_id_columns(_join_details(out, tables, heavy, staged=is_staged(heavy)))


def join_cardinality_check(tables: Tables, heavy: Mapping | None = None) -> DataFrame:
    """Rows before and after each join of ``build_final_dataset``."""
    users = latest_user_record(tables["user_logs"])
    return join_cardinality(
        tables["user_referrals"].distinct(),
        [
            ("user_referral_logs", latest_log_per_referral(tables["user_referral_logs"]), "referral_id", "user_referral_id"),
            ("user_referral_statuses", tables["user_referral_statuses"].distinct(), "user_referral_status_id", "id"),
            ("referral_rewards", tables["referral_rewards"].distinct(), "referral_reward_id", "id"),
            ("paid_transactions", tables["paid_transactions"].distinct(), "transaction_id", "transaction_id"),
            ("user_logs_referrer", users, "referrer_id", "user_id"),
            ("user_logs_referee", users, "referee_id", "user_id"),
            ("lead_logs", latest_lead_record(tables["lead_logs"]), "referee_id", "lead_id"),
        ],
        heavy,
        measured({}, {name: tables[name] for name in DIMENSIONS})[1],
    )


def duplicate_id_count(df: DataFrame, key: str = "referral_id") -> DataFrame:
    """Rows whose key another row has already used."""
    return df.agg((F.count("*") - F.count_distinct(key) - F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("duplicates"))


# --- rules --------------------------------------------------------------------------------------------


def derive_source_category(df: DataFrame) -> DataFrame:
    """Category by referral source, else the lead's own category, else empty."""
    source = norm_str(F.col("referral_source"))
    category = F.when(source == "user sign up", "Online").when(source == "draft transaction", "Offline")
    if "source_category" in df.columns:
        # A referral without a source is not known to be neither of the two, so it takes no lead category.
        own = F.col("source_category")
        category = category.when(source.isNotNull() & (strip_ws(own) != ""), own)
    return df.withColumn("referral_source_category", category.otherwise(""))


def _word_is(column: str, word: str) -> Column:
    return norm_str(F.col(column)) == word


# Columns with the times before they were shifted to local.
UTC_COPIES = {"transaction_at": "_transaction_at_utc", "referral_at": "_referral_at_utc"}


def _flag(df: DataFrame, column: str) -> Column:
    """Flag that may be boolean already; missing counts as false."""
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return coalesce_false(F.col(column))
    return parse_bool(F.col(column))


def _number(df: DataFrame, column: str) -> Column:
    """Number that may be a double already; what is no number is null."""
    c = F.col(column)
    return F.when(~F.isnan(c), c) if isinstance(df.schema[column].dataType, T.DoubleType) else to_number(c)


def _rules(df: DataFrame, compare_in_utc: bool = False) -> dict[str, Column]:
    """The ten rules in order. A rule whose column is absent, or whose value is null, does not hold.

    Transaction and referral are compared as the wall clocks of their own zones, or ``compare_in_utc``, for which
    the table needs the columns ``joined_report`` keeps with ``keep_utc``.
    """
    has = set(df.columns)
    paid_at, referred_at = (F.col(UTC_COPIES[c] if compare_in_utc else c) for c in ("transaction_at", "referral_at"))
    checked_at = "transaction_at" if "transaction_at" in has else "referral_at"
    rules = {
        "rule_reward_positive": (["reward_value"], lambda: _number(df, "reward_value") > 0),
        "rule_status_success": (["description"], lambda: _word_is("description", "berhasil")),
        "rule_transaction_exists": (["transaction_id"], lambda: strip_ws(F.col("transaction_id").cast("string")) != ""),
        "rule_transaction_paid": (["transaction_status"], lambda: _word_is("transaction_status", "paid")),
        "rule_transaction_new": (["transaction_type"], lambda: _word_is("transaction_type", "new")),
        "rule_transaction_after_referral": (["transaction_at", "referral_at"], lambda: paid_at > referred_at),
        "rule_same_month": (["transaction_at", "referral_at"], lambda: same_month(paid_at, referred_at)),
        "rule_membership_active": (
            ["membership_expired_date_referrer", checked_at],
            lambda: F.col("membership_expired_date_referrer") > F.col(checked_at),
        ),
        "rule_referrer_not_deleted": (["is_deleted_referrer"], lambda: ~_flag(df, "is_deleted_referrer")),
        "rule_reward_granted": (["is_reward_granted"], lambda: _flag(df, "is_reward_granted")),
    }
    return {
        name: F.coalesce(holds(), F.lit(False)) if has.issuperset(needs) else F.lit(False)
        for name, (needs, holds) in rules.items()
    }


def business_rules(df: DataFrame, compare_in_utc: bool = False) -> DataFrame:
    """Adds the ten rule columns and ``is_business_logic_valid``, true if all ten hold."""
    rules = _rules(df, compare_in_utc)
    valid = reduce(lambda a, b: a & b, [F.col(name) for name in rules])
    return df.withColumns(rules).withColumn("is_business_logic_valid", valid)


def validate(df: DataFrame, compare_in_utc: bool = False) -> DataFrame:
    """Adds ``is_business_logic_valid`` alone."""
    return df.withColumn("is_business_logic_valid", reduce(lambda a, b: a & b, _rules(df, compare_in_utc).values()))


# --- output -------------------------------------------------------------------------------------------


def _fill_word(column: str) -> str:
    return "UNKNOWN" if CLUB_PART in column.lower() else "Unknown"


def _as_is(column: str) -> bool:
    return any(part in column.lower() for part in AS_IS_PARTS)


def _blank_to(c: Column, word: str) -> Column:
    return F.when(F.coalesce(strip_ws(c), F.lit("")) == "", F.lit(word)).otherwise(c)


def _missing_word(c: Column) -> Column:
    """Null, or a word for a missing value. Lower case is worked out for short texts only, as it shortens none."""
    return c.isNull() | ((F.length(c) <= max(map(len, MISSING_WORDS))) & F.lower(c).isin(*MISSING_WORDS))


def formatted_columns(df: DataFrame, flags: Sequence[str] = FLAG_COLUMNS) -> list[str]:
    """Text columns and flags that are shown as words for readers."""
    return [f.name for f in df.schema.fields if (isinstance(f.dataType, T.StringType) or f.name in flags) and not _as_is(f.name)]


def format_strings(df: DataFrame, flags: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """Text for readers: words capitalized, blanks shown as ``Unknown``.

    Ids, zones and phones stay as they are; club names keep their case. ``flags`` are shown as words,
    since a missing one needs a third value.
    """
    formatted = formatted_columns(df, flags)
    clubs = [c for c in formatted if CLUB_PART in c.lower()]
    # Spacing comes first, as a column of its own, so that it is worked out once per text.
    spaced = df.withColumns({c: single_spaced(F.col(c).cast("string")) for c in formatted if c not in clubs})
    words = {c: F.when(_missing_word(F.col(c)), "Unknown").otherwise(F.initcap(c)) for c in formatted if c not in clubs}
    return spaced.withColumns(words | {c: _blank_to(F.col(c), "UNKNOWN") for c in clubs})


def normalize_enums(df: DataFrame, columns: Sequence[str] = ("transaction_status", "transaction_type")) -> DataFrame:
    """``PAID`` and ``paid`` to ``Paid``, ``NEW`` to ``New``; other words are capitalized, blanks stay blank."""
    return df.withColumns(
        {c: F.when(is_missing_string(F.col(c)), "").otherwise(initcap_words(F.col(c))) for c in columns if c in df.columns}
    )


def select_report_columns(df: DataFrame) -> DataFrame:
    missing = [c for c in REPORT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"report columns missing: {missing}")
    return df.select(*REPORT_COLUMNS)


def finalize_fill(df: DataFrame, filled: Sequence[str] = ()) -> DataFrame:
    """No nulls and no blanks: epoch, false, 0, ``UNKNOWN`` for clubs, ``Unknown`` for other text.

    ``filled`` names text columns known to have neither.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = c if f.name in filled else _blank_to(c, _fill_word(f.name))
        else:
            default = typed_default(f.dataType)
            c = c if default is None else F.coalesce(c, default)
        out.append((c.cast("double") if f.name in DOUBLE_COLUMNS else c).alias(f.name))
    return df.select(*out)


def expect_row_count(df: DataFrame, expected: int) -> DataFrame:
    """Raise unless the table has exactly this many rows. It is written once, and what was written is counted and returned."""
    written = stored(df)
    found = written.count()
    if found != expected:
        raise ValueError(f"expected {expected} rows, got {found}")
    return written


def finalize_output(df: DataFrame, expected_rows: int | None = None, filled: Sequence[str] = ()) -> DataFrame:
    out = finalize_fill(select_report_columns(df), filled)
    return out if expected_rows is None else expect_row_count(out, expected_rows)


def preview(df: DataFrame, rows: int = 5, key: str = "referral_id") -> DataFrame:
    return df.orderBy(key).limit(rows)


def report_row(df: DataFrame, key: str, column: str = "referral_id") -> DataFrame:
    """One report row for a spot check, by key."""
    return df.where(F.col(column) == key)


# --- report -------------------------------------------------------------------------------------------


# What the report shows of a user, or decides by.
USER_FIELDS = ("name", "phone_number", "homeclub", "membership_expired_date", "is_deleted")

# Columns that the first step of a large report holds: what it shows or is judged by.
STEP_COLUMNS = (*REPORT_COLUMNS, *UTC_COPIES.values())


def user_profiles(users: DataFrame, fields: Sequence[str] = ()) -> DataFrame:
    """One row per user: the record with the latest membership end, and the zone of the last row.

    Both come from one grouped aggregate, so the user table is shuffled once and reduced before that.
    ``fields`` narrows the record to some columns; the record is one value, so the optimizer cannot.
    """
    fields = [c for c in fields or users.columns if c != "user_id"]
    newest = F.struct("membership_expired_date", (-F.col("id")).alias("first_id"))
    return (
        users.groupBy("user_id")
        .agg(
            F.max_by(F.struct(*fields), newest).alias("record"),
            F.max_by("timezone_homeclub", "id").alias("lookup_zone"),
        )
        .select("user_id", "record.*", "lookup_zone")
    )


def joined_report(
    cleaned: Tables,
    heavy: Mapping | None = None,
    log_order: str = LATEST_LOG,
    user_fields: Sequence[str] = (),
    keep_utc: bool = False,
    small: Mapping[str, bool] | None = None,
    staged: bool = False,
    needed: Sequence[str] = (),
) -> DataFrame:
    """Cleaned tables to the wide local-time table.

    Gives the rows of ``build_final_dataset(apply_timezones(...))``, but each wide referral row meets the
    user table twice instead of four times: the zone travels with the user record. The newest log is the
    one with the latest local wall clock; ``log_order="instant"`` saves the zone lookup for logs and picks
    another log only if a clock change repeats an hour. ``user_fields`` narrows what is joined of users,
    ``keep_utc`` also keeps the times of referral and transaction as they were (``UTC_COPIES``). ``staged`` stores
    the table before its last shuffle join, of which only ``needed`` columns if some are named.
    """
    base = cleaned["user_referrals"]
    profiles = user_profiles(_own_zone("user_logs", cleaned["user_logs"]), user_fields)
    zone = F.coalesce("lookup_zone_referrer", "lookup_zone_referee")
    out = join_referee(join_referrer(base, profiles, heavy, distinct=True), profiles, heavy).withColumn("_zone", zone)
    if keep_utc:
        out = out.withColumn(UTC_COPIES["referral_at"], F.col("referral_at"))
    out = convert_utc_to_local(out, _timestamps(base), "_zone")
    out = out.drop("_zone", "lookup_zone_referrer", "lookup_zone_referee")
    details = dict(cleaned)
    for name in ("lead_logs", "paid_transactions"):
        details[name] = _own_zone(name, cleaned[name])
    if keep_utc:
        paid = cleaned["paid_transactions"].withColumn(UTC_COPIES["transaction_at"], F.col("transaction_at"))
        details["paid_transactions"] = convert_utc_to_local(paid, ["transaction_at"], ZONE_COLUMNS["paid_transactions"])
    if log_order == LATEST_LOG:
        logs = cleaned["user_referral_logs"]
        details["user_referral_logs"] = _local_logs(logs, cleaned["user_referrals"], cleaned["user_logs"], heavy)
    return drop_join_id_columns(_join_details(out, details, heavy, small, staged, needed))


def referral_report(
    tables: Tables,
    reward_parse: str = "number",
    log_order: str = LATEST_LOG,
    rows_per_task: int = ROWS_PER_TASK,
    expected_rows: int | None = None,
    compare_in_utc: bool = False,
) -> DataFrame:
    """Raw tables to the 31-column report, one row per referral. That of large tables is made in two steps."""
    cleaned = clean_tables(tables, REWARD_PARSERS[reward_parse])
    heavy, small = survey(tables, rows_per_task)
    wide = joined_report(cleaned, heavy, log_order, USER_FIELDS, compare_in_utc, small, is_staged(heavy), STEP_COLUMNS)
    judged = select_report_columns(validate(derive_source_category(wide), compare_in_utc))
    return finalize_output(format_strings(judged), expected_rows, filled=formatted_columns(judged))
