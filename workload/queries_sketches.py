"""Sketches, stored profiles, quarantine, JSON shapes and keyed pseudonyms on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierloom.functions import hmac_sha256, pseudonymize_address
from tierloom.operators import contracts as K, json_shapes as J, quarantine as Q, sketches as S
from tierloom.operators.profile_states import merge_states, profile_of, profile_states, write_states
from tierloom.plans import emails as M
from tierloom.session import scratch_dir
from tierloom.sources.readers import scan_table
from workload.queries_emails import ALL_RULES_SQL, AS_OF, RULE_SQL
from workload.registry import query
from workload.shapes import EMAILS


def _table(spark, sf, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- layers without matching keys -----------------------------------------------------------------------

# Silver holds prices in cents, without some rows, with copies of others, and one row in a hundred is far off.
_CENTS = "case when l_orderkey % 100 = 7 then 1e12 else l_extendedprice * 100 end"


@query(
    f"""WITH silver AS (SELECT {_CENTS} AS price FROM lineitem, (VALUES (0), (1)) AS copies(copy)
      WHERE l_orderkey % 9 > 0 AND (copy = 0 OR l_orderkey % 4 = 0)),
    ratios AS (SELECT unnest(a.q) AS of_raw, unnest(b.q) AS of_silver
      FROM (SELECT quantile_cont(l_extendedprice, [{", ".join(map(str, S.RANKS))}]) AS q FROM lineitem) AS a,
        (SELECT quantile_cont(price, [{", ".join(map(str, S.RANKS))}]) AS q FROM silver) AS b)
    SELECT 'price' AS "column", round(log10(median(of_silver / of_raw)), 1) AS magnitude,
      round(log10(min(of_silver / of_raw)), 0) AS least, round(log10(max(of_silver / of_raw)), 0) AS greatest FROM ratios"""
)
def scale_drift_quantiles(spark, sf):
    raw = _table(spark, sf, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("price"))
    copies = F.expr("case when l_orderkey % 4 = 0 then array(0, 1) else array(0) end")
    silver = _table(spark, sf, "lineitem").where("l_orderkey % 9 > 0").select(F.expr(_CENTS).alias("price"), F.explode(copies))
    found = S.scale_drift_quantiles(raw, silver, ["price"], k=4000)
    power = lambda c, digits: F.round(F.log10(c), digits)
    return found.select("column", power("median_ratio", 1).alias("magnitude"), power("least_ratio", 0).alias("least"), power("greatest_ratio", 0).alias("greatest"))


@query(
    """WITH r AS (SELECT DISTINCT o_orderkey FROM orders), s AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 > 0
      UNION SELECT -o_orderkey FROM orders WHERE o_orderkey % 11 = 0)
    SELECT count(*) FILTER (WHERE s.o_orderkey IS NULL) AS raw_only, count(*) FILTER (WHERE r.o_orderkey IS NULL) AS silver_only,
      count(*) FILTER (WHERE r.o_orderkey = s.o_orderkey) AS matched,
      count(*) FILTER (WHERE r.o_orderkey = s.o_orderkey) / count(r.o_orderkey) AS matched_share
    FROM r FULL JOIN s ON r.o_orderkey = s.o_orderkey"""
)
def key_traceability_sketched(spark, sf):
    """Sketches of four loads of each layer, kept and merged. Exact while a layer has at most 2 ** 20 keys."""
    orders = _table(spark, sf, "orders")
    silver = orders.where("o_orderkey % 7 > 0").unionByName(orders.where("o_orderkey % 11 = 0").withColumn("o_orderkey", -F.col("o_orderkey")))
    merged = []
    for layer in (orders, silver):
        path = scratch_dir(spark)
        for load in range(4):
            S.key_sketch(layer.where(F.pmod("o_custkey", F.lit(4)) == load), ["o_orderkey"], 20).write.mode("append").parquet(path)
        merged.append(S.merge_key_sketches(scan_table(spark, path), 20))
    return S.trace_keys(*merged)


_RAW_COLUMNS = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_totalprice": "o_totalprice", "o_orderstatus": "o_orderstatus"}
_SILVER_COLUMNS = {
    "order_no": "'ORD-' || lpad(cast(o_orderkey as string), 12, '0')",
    "customer": "cast(o_custkey as string)",
    "price": "o_totalprice",
    "gross": "o_totalprice * 1.5 + 0.125",
    "weekday": "o_orderkey % 7",
    "digest": "md5(cast(o_orderkey as string))",
}


def _values_sql(columns: dict[str, str], where: str) -> str:
    texts = {"value": "lower(trim(cast({0} as string)))", "digits": "regexp_replace(regexp_replace(cast({0} as string), '[^0-9]', '', 'g'), '^0+(.)', '\\1')"}
    forms = lambda e: texts if "||" in e or "md5" in e or "string" in e else {"value": texts["value"]}
    return " UNION ".join(
        f"SELECT '{name}' AS c, '{form}' AS f, {text.format('(' + e + ')')} AS v FROM orders WHERE {where}" for name, e in columns.items() for form, text in forms(e).items()
    )


@query(
    f"""WITH r AS ({_values_sql(_RAW_COLUMNS, "true")}), s AS ({_values_sql(_SILVER_COLUMNS, "o_orderkey % 5 > 0")}),
    sizes AS (SELECT 'r' AS side, c, f, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 's', c, f, count(*) FROM s GROUP BY ALL),
    shared AS (SELECT r.c AS raw_column, r.f AS raw_form, s.c AS silver_column, s.f AS silver_form, count(*) AS n FROM r JOIN s USING (v)
      WHERE r.f = 'value' OR s.f = 'value' GROUP BY ALL),
    rated AS (SELECT shared.*, a.n AS of_raw, b.n AS of_silver FROM shared JOIN sizes a ON a.side = 'r' AND a.c = raw_column AND a.f = raw_form
      JOIN sizes b ON b.side = 's' AND b.c = silver_column AND b.f = silver_form)
    SELECT silver_column, raw_column, raw_form, silver_form FROM rated
    WHERE of_silver >= 20 AND n >= 0.9 * of_silver AND n >= 0.2 * (of_raw + of_silver - n)
    QUALIFY row_number() OVER (PARTITION BY silver_column ORDER BY round(n / (of_raw + of_silver - n), 2) DESC, silver_form DESC, raw_column) = 1"""
)
def column_origins(spark, sf):
    orders = _table(spark, sf, "orders")
    raw = orders.selectExpr(*[f"{e} as {c}" for c, e in _RAW_COLUMNS.items()])
    silver = orders.where("o_orderkey % 5 > 0").selectExpr(*[f"{e} as {c}" for c, e in _SILVER_COLUMNS.items()])
    return S.column_origins(raw, silver, lg=14).select("silver_column", "raw_column", "raw_form", "silver_form")


# --- profiles that add up -------------------------------------------------------------------------------

_STATE_BOUNDS = {
    "event_id": "cast({}(event_id) AS varchar)",
    "ts": "strftime({}(ts), '%Y-%m-%d %H:%M:%S.%f')",
    "user_id": "cast({}(user_id) AS varchar)",
    "event_type": "cast(NULL AS varchar)",
    "value": "cast({}(value) AS varchar)",
    "props": "cast(NULL AS varchar)",
}


@query(
    " UNION ALL ".join(
        f"(SELECT 'events' AS \"table\", '{c}' AS \"column\", count(*) AS \"rows\", count(*) - count({c}) AS null_count, "
        f"{b.format('min')} AS \"min\", {b.format('max')} AS \"max\", true AS distinct_within_error FROM events)"
        for c, b in _STATE_BOUNDS.items()
    )
)
def profile_merged_by_day(spark, sf):
    """States of each day, stored, one day twice; the distinct counts are compared with exact ones."""
    events, path = _table(spark, sf, "events"), scratch_dir(spark)
    day = F.date_format("ts", "yyyy-MM-dd")
    for part in (events, events.where(F.dayofmonth("ts") == 1)):
        write_states(profile_states(part, "events", day), path)
    merged = profile_of(merge_states(scan_table(spark, path)))
    exact = events.agg(*[F.count_distinct(c).alias(c) for c in _STATE_BOUNDS]).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in _STATE_BOUNDS])))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.08 * F.col("exact")
    return merged.join(exact, "column").select("table", "column", "rows", "null_count", "min", "max", close.alias("distinct_within_error"))


# --- rows that break rules ------------------------------------------------------------------------------

_BROKEN = "list_filter([" + ", ".join(f"case when {broken} then '{rule}:{c}' end" for rule, parts in RULE_SQL.items() for c, broken in parts) + "], lambda x: x IS NOT NULL)"


def _split(spark, sf) -> Q.Split:
    return Q.split_rows(EMAILS.spark(spark, sf), K.rule_predicates(M.DATASET_CONTRACT, now=AS_OF), scratch_dir(spark))


@query(f"SELECT row_id, array_to_string({_BROKEN}, ',') AS broken FROM emails WHERE len({_BROKEN}) > 0")
def quarantine_rows(spark, sf):
    return _split(spark, sf).quarantine.select("row_id", F.array_join(Q.BROKEN, ",").alias("broken"))


@query(f"SELECT row_id FROM emails WHERE len({_BROKEN}) = 0")
def accepted_rows(spark, sf):
    return _split(spark, sf).good.select("row_id")


@query(ALL_RULES_SQL)
def quarantine_counts(spark, sf):
    return _split(spark, sf).counts


# --- JSON and pseudonyms --------------------------------------------------------------------------------

# Properties of an event, some of them nested, as a list, of another type, or broken.
_PROPS = (
    "case when event_id % 10 = 3 then '{\"k\": \"' || event_type || '\", \"tags\": [1, \"x\", null]}' "
    "when event_id % 10 = 4 then '{\"k\": 1.5, \"in\": {\"user\": ' || cast(user_id as string) || '}}' "
    "when event_id % 10 = 5 then substring(props, 1, 4) when event_id % 10 = 6 then null else props end"
)
_VALID = "json_valid(p)"


@query(
    f"""SELECT event_id, p IS NOT NULL AND NOT {_VALID} AS bad, case when {_VALID} then try_cast(json_extract_string(p, '$.k') AS bigint) end AS number,
      case when {_VALID} then json_extract_string(p, '$.k') end AS k, case when {_VALID} then cast(json_extract_string(p, '$.in.user') AS bigint) end AS user_id,
      case when {_VALID} then json_extract_string(p, '$.tags[1]') end AS tag
    FROM (SELECT event_id, {_PROPS} AS p FROM events) AS e""".replace(
        "try_cast(json_extract_string(p, '$.k') AS bigint)", "case when json_type(p, '$.k') IN ('UBIGINT', 'BIGINT') then cast(json_extract_string(p, '$.k') AS bigint) "
        "when json_type(p, '$.k') = 'DOUBLE' then 1 end"
    )
)
def json_event_fields(spark, sf):
    events = _table(spark, sf, "events").selectExpr("event_id", f"{_PROPS} as p")
    fields = {"number": ("$.k", "bigint"), "k": ("$.k", "string"), "user_id": ("$.in.user", "bigint"), "tag": ("$.tags[1]", "string")}
    return J.with_json_fields(events, "p", fields, bad="bad").drop("p")


@query(
    f"""SELECT count(*) AS "rows", count(*) - count(p) AS nulls, count(p) - count(p) FILTER (WHERE {_VALID}) AS bad,
      'OBJECT<in: OBJECT<user: BIGINT>, k: VARIANT, tags: ARRAY<VARIANT>>' AS schema FROM (SELECT {_PROPS} AS p FROM events) AS e"""
)
def json_report(spark, sf):
    return J.json_report(_table(spark, sf, "events").selectExpr(f"{_PROPS} as p"), "p")


@query(
    "SELECT row_id, right(sender, length(sender) - instr(sender, '@')) AS domain, true AS same, length(sender) > 0 AS hidden FROM emails WHERE instr(sender, '@') > 0"
)
def pseudonymize_keyed(spark, sf):
    """Domains survive, equal addresses stay equal, and the local part is gone."""
    key = b"a key of the company"
    emails = EMAILS.spark(spark, sf).where("instr(sender, '@') > 0").select("row_id", "sender", pseudonymize_address(F.col("sender"), key).alias("p"))
    return emails.select(
        "row_id",
        F.substring_index("p", "@", -1).alias("domain"),
        (F.substring_index("p", "@", 1) == hmac_sha256(F.lower(F.col("sender")), key)).alias("same"),
        (~F.contains("p", F.substring_index("sender", "@", 1))).alias("hidden"),
    )
