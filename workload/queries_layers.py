"""Profiles and comparisons of layers, on the given tables as they are and on employments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierloom.functions import offset_to_utc, truncate_to_ms
from tierloom.operators import reconcile as X
from tierloom.operators.profile import profile_table, profile_tables
from tierloom.session import scratch_dir
from tierloom.sources.readers import scan_table
from tierloom.sources.writers import write_profile
from workload.queries_contacts import employments
from workload.registry import query
from workload.shapes import EMPLOYMENTS


def _table(spark, sf, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- profiles -------------------------------------------------------------------------------------------

_PROFILED = {
    "events": (
        ("event_id", "bigint", "number"), ("ts", "timestamp_ntz", "time"), ("user_id", "bigint", "number"),
        ("event_type", "string", "text"), ("value", "double", "number"), ("props", "string", "text"),
    ),
    "customer": (
        ("c_custkey", "bigint", "number"), ("c_name", "string", "text"), ("c_nationkey", "int", "number"),
        ("c_acctbal", "double", "number"), ("c_mktsegment", "string", "text"),
    ),
}


def _profile_sql(table: str) -> str:
    bounds = {
        "number": "cast({}({}) AS varchar)",
        "time": "strftime({}({}), '%Y-%m-%d %H:%M:%S.%f')",
        "text": "cast(NULL AS varchar)",
    }
    return " UNION ALL ".join(
        f"(SELECT '{table}' AS \"table\", '{c}' AS \"column\", '{dtype}' AS dtype, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count, {bounds[kind].format('min', c)} AS \"min\", {bounds[kind].format('max', c)} AS \"max\" "
        f"FROM {table})"
        for c, dtype, kind in _PROFILED[table]
    )


@query(_profile_sql("events"), name="profile_table")
def events_profile(spark, sf):
    return profile_table(_table(spark, sf, "events"), "events")


@query(f"{_profile_sql('events')} UNION ALL {_profile_sql('customer')}", name="write_profile")
def written_profiles(spark, sf):
    profiles = profile_tables({name: _table(spark, sf, name) for name in _PROFILED})
    return scan_table(spark, write_profile(profiles, scratch_dir(spark)))


# --- raw against silver ---------------------------------------------------------------------------------

_SHARED = (
    "contact_id", "employer_name", "title", "occupation", "start_date", "end_date", "is_current", "organization_id",
    "processing_date",
)


@query(
    " UNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", (SELECT avg(cast({c} IS NULL AS double)) FROM employments_raw) AS raw_null_rate, "
        f"(SELECT avg(cast({c} IS NULL AS double)) FROM silver_employments) AS silver_null_rate)"
        for c in _SHARED
    )
)
def null_rate_by_layer(spark, sf):
    return X.null_rate_by_layer(EMPLOYMENTS.spark(spark, sf), employments(spark, sf))


_RAW_PRICES = ("o_orderkey", "case when o_orderkey % 3 = 0 then null else o_totalprice end as price", "nullif(o_custkey % 4, 0) as grade")


@query(
    "SELECT unnest(['price', 'grade']) AS \"column\", unnest([count(*) FILTER (WHERE price IS NULL AND coalesce(price, 0) = 0), "
    "count(*) FILTER (WHERE grade IS NULL AND coalesce(grade, 0) = 0)]) AS defaulted "
    f"FROM (SELECT {', '.join(_RAW_PRICES)} FROM orders) AS r"
)
def nulls_became_default(spark, sf):
    raw = _table(spark, sf, "orders").selectExpr(*_RAW_PRICES)
    return X.nulls_became_default(raw, raw.na.fill(0), ["o_orderkey"], ["price", "grade"])


_ITEM = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "SELECT 'l_discount' AS \"column\", min(l_discount) AS raw_min, max(l_discount) AS raw_max, min(l_discount * 100) AS silver_min, "
    "max(l_discount * 100) AS silver_max, round(quantile_disc(case when l_discount <> 0 then (l_discount * 100) / l_discount end, 0.5), 6) "
    "AS median_ratio FROM lineitem"
)
def scale_drift(spark, sf):
    raw = _table(spark, sf, "lineitem").select(*_ITEM, "l_discount")
    silver = raw.withColumn("l_discount", F.col("l_discount") * 100)
    return X.scale_drift(raw, silver, ["l_discount"], _ITEM).withColumn("median_ratio", F.round("median_ratio", 6))


# Raw layers with a key that has a third of all rows, keys of a few rows, and copies; silver has one row per key.
_RAW_REPEATED_PRICES = (
    "case when o_orderkey % 3 = 0 then -1 else o_custkey end as account",
    "case when o_custkey % 2 = 0 then null else o_totalprice end as price",
    "nullif(o_orderkey % 4, 0) as grade",
)
_RAW_RATES = ("case when l_orderkey % 3 = 0 then 0 else l_orderkey end as item", "l_discount as rate")


@query(
    f"SELECT unnest(['price', 'grade']) AS \"column\", unnest([count(*) FILTER (WHERE r.price IS NULL AND s.price = 0), "
    f"count(*) FILTER (WHERE r.grade IS NULL AND s.grade = 0)]) AS defaulted FROM (SELECT {', '.join(_RAW_REPEATED_PRICES)} "
    "FROM orders) AS r JOIN (SELECT account, min(coalesce(price, 0)) AS price, min(coalesce(grade, 0)) AS grade FROM "
    f"(SELECT {', '.join(_RAW_REPEATED_PRICES)} FROM orders) AS q GROUP BY account) AS s USING (account)"
)
def nulls_became_default_repeated(spark, sf):
    raw = _table(spark, sf, "orders").selectExpr(*_RAW_REPEATED_PRICES)
    silver = raw.na.fill(0).groupBy("account").agg(F.min("price").alias("price"), F.min("grade").alias("grade"))
    return X.nulls_became_default(raw, silver, ["account"], ["price", "grade"])


@query(
    f"WITH r AS (SELECT {', '.join(_RAW_RATES)} FROM lineitem CROSS JOIN (VALUES (0), (1)) AS copies(copy) "
    "WHERE copy = 0 OR l_linenumber = 1), s AS (SELECT item, max(rate) * 100 AS rate FROM r GROUP BY item) "
    "SELECT 'rate' AS \"column\", (SELECT min(rate) FROM r) AS raw_min, (SELECT max(rate) FROM r) AS raw_max, "
    "(SELECT min(rate) FROM s) AS silver_min, (SELECT max(rate) FROM s) AS silver_max, (SELECT round(quantile_disc(case when "
    "r.rate <> 0 then s.rate / r.rate end, 0.5), 6) FROM r JOIN s USING (item)) AS median_ratio"
)
def scale_drift_repeated(spark, sf):
    lines = _table(spark, sf, "lineitem")
    copies = F.explode(F.when(F.col("l_linenumber") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    raw = lines.withColumn("copy", copies).selectExpr(*_RAW_RATES)
    silver = raw.groupBy("item").agg((F.max("rate") * 100).alias("rate"))
    return X.scale_drift(raw, silver, ["rate"], ["item"]).withColumn("median_ratio", F.round("median_ratio", 6))


@query(
    "SELECT count(*) FILTER (WHERE r AND NOT s) AS raw_only, count(*) FILTER (WHERE s AND NOT r) AS silver_only, "
    "count(*) FILTER (WHERE r AND s) AS matched, cast(count(*) FILTER (WHERE r AND s) AS double) / count(*) FILTER (WHERE r) "
    "AS matched_share FROM (SELECT k, bool_or(r) AS r, bool_or(s) AS s FROM (SELECT o_custkey AS k, true AS r, false AS s FROM orders "
    "UNION ALL SELECT c_custkey + 100, false, true FROM customer) AS u GROUP BY k) AS g"
)
def key_traceability(spark, sf):
    raw = _table(spark, sf, "orders").select(F.col("o_custkey").alias("account"))
    silver = _table(spark, sf, "customer").select((F.col("c_custkey") + 100).alias("account"))
    return X.key_traceability(raw, silver, ["account"])


@query(
    "(SELECT 'is_current' AS \"column\", lower(cast(is_current AS varchar)) AS value, count(*) AS row_count, "
    "coalesce(lower(cast(is_current AS varchar)) IN ('true', 'false'), false) AS expected FROM employments_raw GROUP BY ALL)"
)
def boolean_domain(spark, sf):
    return X.boolean_domain(EMPLOYMENTS.spark(spark, sf), ["is_current"])


@query(
    "SELECT organization_id, processing_date, contact_id, employer_name, title, occupation, start_date, end_date, is_current, "
    "timestamp '2026-04-01 00:00:00' AS _loaded_at, 'contact_employments_raw' AS _source_table, "
    "cast(processing_date AS timestamp) AS _source_timestamp FROM silver_employments"
)
def add_lineage_columns(spark, sf):
    loaded, first = F.lit("2026-04-01 00:00:00").cast("timestamp"), ["organization_id", "processing_date"]
    stamp = F.col("processing_date").cast("timestamp")
    return X.add_lineage_columns(employments(spark, sf), "contact_employments_raw", stamp, loaded, first)


@query(
    "SELECT 'raw' AS layer, count(*) AS row_count, count(DISTINCT trim(contact_id)) AS contacts FROM employments_raw "
    "UNION ALL SELECT 'silver', count(*), count(DISTINCT trim(contact_id)) FROM silver_employments "
    "UNION ALL SELECT 'gold', count(*), cast(sum(n) AS bigint) FROM "
    "(SELECT organization_id, count(DISTINCT contact_id) AS n FROM silver_employments GROUP BY ALL) AS g"
)
def layer_row_counts(spark, sf):
    from tierloom.plans.gold import contacts_by_org

    silver = employments(spark, sf)
    contacts = {"contacts": F.count_distinct(F.trim("contact_id"))}
    details = X.layer_row_counts({"raw": EMPLOYMENTS.spark(spark, sf), "silver": silver}, contacts)
    return details.unionByName(X.layer_row_counts({"gold": contacts_by_org(silver)}, {"contacts": F.sum("contact_count")}))


# --- times ----------------------------------------------------------------------------------------------


@query("SELECT event_id, ts - interval 7 hour AS sent_at FROM events", name="offset_to_utc")
def event_offset_to_utc(spark, sf):
    events = _table(spark, sf, "events").selectExpr("event_id", "cast(ts as string) || '+07:00' as sent")
    return events.select("event_id", offset_to_utc(F.col("sent")).alias("sent_at"))


@query("SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events", name="truncate_to_ms")
def event_milliseconds(spark, sf):
    return _table(spark, sf, "events").select("event_id", truncate_to_ms(F.col("ts").cast("timestamp")).alias("ts"))
