"""Given tables in the shape of the plans' inputs.

Every shape is one SELECT whose expressions mean the same in Spark SQL and in DuckDB, so both engines start
from equal rows. ``copy`` numbers the copies of a row: shapes that need repeated keys emit a second copy of
some rows beside all first ones.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


def uuid_of(column: str) -> str:
    """Text in UUID form made from the MD5 of a column."""
    digest = f"md5(cast({column} as string))"
    parts = [f"substr({digest}, {start}, {length})" for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return " || '-' || ".join(parts)


@dataclass(frozen=True)
class Shape:
    source: str
    columns: dict[str, str]
    join: tuple[str, str] | None = None
    second_copy: str = ""

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{self.source}.parquet")
        if self.join:
            other, condition = self.join
            left, right = condition.split(" = ")
            dim = spark.read.parquet(f"{sf_dir}/{other}.parquet")
            df = df.join(dim, df[left] == dim[right])
        if self.second_copy:
            df = df.selectExpr("*", f"explode(case when {self.second_copy} then array(0, 1) else array(0) end) as copy")
        out = df.selectExpr(*[f"{e} as `{c}`" for c, e in self.columns.items()])
        # Wall clocks become instants of the session zone, UTC.
        return out.select(*[out[c].cast("timestamp") if t == "timestamp_ntz" else out[c] for c, t in out.dtypes])

    def sql(self) -> str:
        text = "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in self.columns.items()) + f" FROM {self.source}"
        if self.join:
            text += f" JOIN {self.join[0]} ON {self.join[1]}"
        if self.second_copy:
            text += f" CROSS JOIN (VALUES (0), (1)) AS copies(copy) WHERE copy = 0 OR {self.second_copy}"
        return text


_ORDER_CUSTOMER = ("customer", "o_custkey = c_custkey")

EMPLOYMENTS = Shape(
    "orders",
    {
        "contact_id": f"' ' || {uuid_of('o_custkey')} || ' '",
        "employer_name": "case when o_orderkey % 11 = 0 then '  ' else ' ' || c_mktsegment end",
        "title": "case when o_orderkey % 13 = 0 then null else o_orderstatus || ' title ' end",
        "occupation": "case when o_orderkey % 17 = 0 then '⟦P:' || cast(o_orderkey as string) || '⟧ ' "
        "else '⟦p:x' || cast(o_orderkey as string) || '⟧ ' || o_orderpriority end",
        "start_date": "cast(o_orderdate as date)",
        "end_date": "case o_orderstatus when 'F' then cast(cast(o_orderdate as date) as string) when 'P' then 'unknown' end",
        "is_current": "case when copy = 1 and o_orderkey % 12 = 0 then true when o_orderstatus = 'O' then true "
        "when o_orderstatus = 'F' then false end",
        "organization_id": "case when c_nationkey = 0 or (copy = 1 and o_orderkey % 8 = 0) then 'org_pii_masking' "
        "else ' org_' || cast(c_nationkey as string) end",
        "processing_date": "case when copy = 1 then date '2026-03-20' else date '2026-03-01' + cast(o_orderkey % 5 as int) end",
        "row_id": "o_orderkey + copy * cast(1000000000 as bigint)",
    },
    join=_ORDER_CUSTOMER,
    second_copy="o_orderkey % 4 = 0",
)

PHONES = Shape(
    "orders",
    {
        "contact_id": f"' ' || {uuid_of('o_custkey')} || ' '",
        "label": "case o_orderpriority when '1-URGENT' then ' MOBILE' when '2-HIGH' then 'Office ' "
        "when '5-LOW' then null else 'facility' end",
        "number": "case when o_custkey % 5 = 0 then '⟦PH:' || cast(o_orderkey as string) || '⟧ +1 (55) 12' "
        "else '⟦PH:' || cast(o_orderkey as string) || '⟧ +1 (555) ' "
        "|| lpad(cast(o_custkey % 3000 + o_orderkey % 2 as string), 7, '0') end",
        "organization_id": "case when c_nationkey = 3 then 'org_pii_masking' else 'org_' || cast(c_nationkey as string) end",
        "processing_date": "date '2026-03-01' + cast(o_orderkey % 5 as int)",
        "row_id": "o_orderkey",
    },
    join=_ORDER_CUSTOMER,
)

REFERRALS = Shape(
    "orders",
    {
        "referral_at": "o_orderdate + interval 5 hour",
        "referral_id": "'ref' || cast(o_orderkey as string)",
        "referee_id": "case when o_orderkey % 19 = 0 then null else cast(o_custkey * 7 % 1600 as string) end",
        "referee_name": "case when o_orderkey % 23 = 0 then ' ' else ' name  of ' || cast(o_custkey as string) end",
        "referee_phone": "md5(cast(o_custkey as string))",
        "referral_reward_id": "case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 end",
        "referral_source": "case o_orderstatus when 'O' then 'User Sign Up' when 'F' then 'draft transaction' else 'Lead' end",
        "referrer_id": "case when o_orderkey % 7 = 0 then null else cast(o_custkey as string) end",
        "transaction_id": "case when o_orderkey % 5 = 0 then null else 'tx' || cast(o_orderkey as string) end",
        "updated_at": "o_orderdate + interval 6 hour",
        "user_referral_status_id": "case o_orderstatus when 'O' then 2 when 'F' then 1 else 3 end",
    },
)

LOGS = Shape(
    "lineitem",
    {
        "id": "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey",
        "user_referral_id": "'ref' || cast(l_orderkey as string)",
        "source_transaction_id": "case when l_linenumber % 2 = 0 then null else 'tx' || cast(l_orderkey as string) end",
        "created_at": "l_shipdate + interval 1 hour",
        "is_reward_granted": "case l_returnflag when 'A' then 'TRUE' when 'N' then 'yes' else 'FALSE' end",
    },
)

USERS = Shape(
    "customer",
    {
        "id": "c_custkey + copy * cast(1000000000 as bigint)",
        "user_id": "cast(c_custkey as string)",
        "name": "' ' || lower(c_name) || '  jr'",
        "phone_number": "md5(c_name)",
        "homeclub": "upper(c_mktsegment)",
        "timezone_homeclub": "case when copy = 1 then 'Asia/Jakarta' when c_nationkey % 5 = 0 then 'asia/makassar' "
        "when c_nationkey % 7 = 0 then 'Mars/Base' else 'Asia/Jakarta' end",
        "membership_expired_date": "case when copy = 1 then timestamp '2002-01-01 00:00:00' "
        "when c_nationkey < 12 then timestamp '1997-01-01 00:00:00' else timestamp '2003-01-01 00:00:00' end",
        "is_deleted": "c_acctbal < 0",
    },
    second_copy="c_custkey % 3 = 0",
)

TRANSACTIONS = Shape(
    "orders",
    {
        "transaction_id": "case when o_orderkey % 3 = 0 then 'old' else 'tx' end || cast(o_orderkey as string)",
        "transaction_status": "case when o_orderkey % 10 = 0 then 'pending' else 'PAID' end",
        "transaction_at": "o_orderdate + interval 29 hour",
        "transaction_location": "'CLUB  ' || cast(o_custkey % 9 as string) || ' north '",
        "timezone_transaction": "case when o_orderkey % 2 = 0 then 'Asia/Jakarta' else 'Asia/Makassar' end",
        "transaction_type": "case when o_orderkey % 8 = 0 then 'REJOIN' else 'NEW' end",
    },
)

LEADS = Shape(
    "events",
    {
        "id": "event_id",
        "lead_id": "cast(user_id as string)",
        "source_category": "case event_type when 'click' then 'Online' when 'view' then 'Offline' else ' ' end",
        "created_at": "date_trunc('day', ts)",
        "preferred_location": "'SITE ' || cast(user_id % 11 as string)",
        "timezone_location": "case when user_id % 2 = 0 then 'Asia/Jakarta' else 'Asia/Makassar' end",
        "current_status": "event_type",
    },
)

STATUSES = Shape(
    "region",
    {
        "id": "r_regionkey + 1",
        "description": "case r_regionkey when 0 then 'Menunggu' when 1 then 'Berhasil' else 'Tidak Berhasil' end",
        "created_at": "timestamp '2031-05-06 07:08:09'",
    },
)

REWARDS = Shape(
    "region",
    {
        "id": "r_regionkey + 1",
        "reward_value": "case r_regionkey when 0 then '10 days' when 1 then '20' else '15.5' end",
        "created_at": "timestamp '2031-10-11 12:13:14'",
        "reward_type": "cast(1 as int)",
    },
)


def _emails(timestamp: str) -> Shape:
    return Shape(
        "conversations",
        {
            "subject": "' subject ' || cast(conv_id as string)",
            "sender": "role || '@example.org'",
            "receiver": "case when turn = 0 then 'not-an-email' else 'care@example.org' end",
            "timestamp": timestamp,
            "message_body": "text",
            "thread_id": f"'aa' || lpad(cast(conv_id % 1000 as string), 3, '0') || '-' || {uuid_of('conv_id')}",
            "email_types": "'[\"inquiry\",\"spam\"]'",
            "email_status": "case turn when 0 then ' Done' when 1 then null else 'ongoing' end",
            "email_criticality": "'low'",
            "product_types": "'[\"IAM service\"]'",
            "agent_effectivity": "'high'",
            "agent_efficiency": "'very low'",
            "customer_satisfaction": "cast((conv_id % 5 - 2) / cast(1.5 as double) as double)",
            "row_id": "conv_id * 100 + turn",
        },
    )


_SENT = "cast(timestamp '2026-01-01 00:00:00' + interval '1' hour * (conv_id * 17 + turn) as string) || '+07:00'"

EMAILS = _emails(f"case when conv_id % 9 = 0 then 'bad' else {_SENT} end")
EMAILS_DATED = _emails(_SENT)

SHAPES = {
    "employments_raw": EMPLOYMENTS,
    "phones_raw": PHONES,
    "referrals": REFERRALS,
    "logs": LOGS,
    "users": USERS,
    "transactions": TRANSACTIONS,
    "leads": LEADS,
    "statuses": STATUSES,
    "rewards": REWARDS,
    "emails": EMAILS,
    "emails_dated": EMAILS_DATED,
}

REFERRAL_TABLES = {
    "user_referrals": REFERRALS,
    "user_referral_logs": LOGS,
    "user_logs": USERS,
    "paid_transactions": TRANSACTIONS,
    "lead_logs": LEADS,
    "user_referral_statuses": STATUSES,
    "referral_rewards": REWARDS,
}


def _changed(shape: Shape, second_copy: str = "", **columns: str) -> Shape:
    return replace(shape, columns=shape.columns | columns, second_copy=second_copy or shape.second_copy)


# The same tables with what makes joins hard: a referrer and a referee that many referrals name, a transaction id
# that repeats on both sides of its join, a referral with many logs, repeated log rows, and zones with clock changes.
HARD = {
    "referrals": _changed(
        REFERRALS,
        referrer_id="case when o_orderkey % 3 = 0 then '1' when o_orderkey % 7 = 0 then null else cast(o_custkey as string) end",
        referee_id="case when o_orderkey % 4 = 0 then '7' when o_orderkey % 19 = 0 then null else cast(o_custkey * 7 % 1600 as string) end",
        transaction_id="case when o_orderkey % 60 = 0 then 'tx-hot' when o_orderkey % 5 = 0 then null else 'tx' || cast(o_orderkey as string) end",
    ),
    "logs": _changed(
        LOGS,
        second_copy="l_linenumber = 1 or l_orderkey % 3 = 0",
        user_referral_id="'ref' || cast(case when l_orderkey % 3 = 0 then 1 else l_orderkey end as string)",
    ),
    "users": _changed(
        USERS,
        timezone_homeclub="case when c_custkey = 1 or c_nationkey % 3 = 0 then 'Europe/Berlin' when c_nationkey % 4 = 0 "
        "then 'America/New_York' when c_nationkey % 7 = 0 then 'Mars/Base' else 'Asia/Jakarta' end",
    ),
    "transactions": _changed(
        TRANSACTIONS,
        transaction_id="case when o_orderkey % 500 = 0 then 'tx-hot' else 'tx' || cast(o_orderkey as string) end",
    ),
}
HARD_SQL = {name: shape.sql() for name, shape in HARD.items()}


def referral_tables(spark: SparkSession, sf_dir: str, hard: bool = False) -> dict[str, DataFrame]:
    names = {id(shape): name for name, shape in SHAPES.items()}
    shapes = {t: HARD.get(names[id(s)], s) if hard else s for t, s in REFERRAL_TABLES.items()}
    return {name: shape.spark(spark, sf_dir) for name, shape in shapes.items()}
