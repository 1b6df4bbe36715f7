"""Drift, traceability, origins and profiles from sketches, against exact answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierloom.operators import sketches as S
from tierloom.operators.profile import profile_table
from tierloom.operators.profile_states import merge_states, profile_of, profile_states, write_states
from tierloom.operators.reconcile import key_traceability, scale_drift


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def test_ratio_within_the_error_of_exact_quantiles(lines):
    """Silver has a third of its rows twice and 1 % outliers; the ends of the ranges say nothing then."""
    raw = lines.select("l_extendedprice")
    grown = F.when(F.rand(1) < 0.01, F.lit(1e12)).otherwise(F.col("l_extendedprice") * 100)
    silver = raw.select(grown.alias("l_extendedprice")).withColumn("copy", F.explode(F.expr("if(rand(2) < 0.33, array(0, 1), array(0))"))).drop("copy")
    k = 200
    found = S.scale_drift_quantiles(raw, silver, ["l_extendedprice"], k=k).first()
    values = np.sort([r[0] for r in raw.collect()])
    slack = 3 * S.rank_error(k) + 0.02
    bounds = [np.quantile(values, np.clip(r + s, 0, 1)) * 100 / np.quantile(values, np.clip(r - s, 0, 1)) for r in S.RANKS for s in (-slack, slack)]
    assert np.quantile(bounds, 0.25) <= found["median_ratio"] <= np.quantile(bounds, 0.75) and abs(found["median_ratio"] - 100) < 15
    ends = scale_drift(raw, silver, ["l_extendedprice"]).first()
    assert ends["silver_max"] / ends["raw_max"] > 1e5


def test_quantiles_of_small_tables_are_exact(rows):
    raw, silver = rows("a double, b int", (1.0, None), (2.0, None), (float("nan"), None), (4.0, None)), rows("a double, b int", (2.0, 1), (4.0, 2), (8.0, None), (None, 4))
    found = {r["column"]: r for r in S.scale_drift_quantiles(raw, silver, ["a", "b"]).collect()}
    assert found["a"][1:] == (2.0, 2.0, 2.0) and found["b"][1:] == (None, None, None)


def test_value_sketches_of_loads_merge(lines):
    whole = S.value_sketches(lines, ["l_quantity"], 4000)
    loads = S.value_sketches(lines.where("l_orderkey % 2 = 0"), ["l_quantity"], 4000).unionByName(S.value_sketches(lines.where("l_orderkey % 2 = 1"), ["l_quantity"], 4000))
    merged = S.merge_value_sketches(loads)
    assert merged.first()["values"] == lines.count()
    ratios = [r["ratio"] for r in S.quantile_ratios(whole, merged).collect()]
    assert max(abs(r - 1) for r in ratios) < 0.2


def exact(df, other, keys):
    return key_traceability(df, other, keys).first().asDict()


@pytest.mark.parametrize("lg", [16, 9])
def test_traceability_within_the_stated_error(spark, sf_dir, lg):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    silver = orders.where("o_orderkey % 7 <> 0").unionByName(orders.where("o_orderkey % 11 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10**9))
    keys = ["o_orderkey", "o_custkey"]
    want, found = exact(orders, silver, keys), S.trace_keys(S.key_sketch(orders, keys, lg), S.key_sketch(silver, keys, lg)).first().asDict()
    size = want["raw_only"] + want["silver_only"] + want["matched"]
    error = 0 if size <= 2**lg else 4 * size / 2 ** (lg / 2)
    for name in ("raw_only", "silver_only", "matched"):
        assert abs(found[name] - want[name]) <= error
    assert abs(found["matched_share"] - want["matched_share"]) <= (0 if not error else 0.2)


def test_key_sketches_of_loads_merge(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    loads = [S.key_sketch(customers.where(f"c_custkey % 3 <> {i}"), ["c_custkey"]) for i in (0, 1)]
    merged = S.merge_key_sketches(loads[0].unionByName(loads[1]))
    assert S.trace_keys(S.key_sketch(customers, ["c_custkey"]), merged).first()["matched_share"] == 1.0


def test_null_and_empty_keys(rows):
    a, b = rows("k string, n int", (None, 1), ("", 1), ("x", None), ("-", 2)), rows("k string, n int", (None, 1), ("=", 1), ("x", None))
    assert S.trace_keys(S.key_sketch(a, ["k", "n"]), S.key_sketch(b, ["k", "n"])).first().asDict() == exact(a, b, ["k", "n"])
    empty = S.trace_keys(S.key_sketch(a.where("false"), ["k"]), S.key_sketch(b.where("false"), ["k"])).first()
    assert tuple(empty) == (0, 0, 0, None)


def test_origins_of_renamed_and_rewritten_columns(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("ref", F.expr("'R:' || upper(hex(o_orderkey * 7919))"))
    silver = raw.where("o_orderkey % 5 <> 0").select(
        F.expr("'ORD-' || lpad(cast(o_orderkey as string), 12, '0')").alias("order_no"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.expr("lower(substring(ref, 3))").alias("reference"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_totalprice") * 1.19).alias("gross"),
        (F.col("o_orderkey") % 7).alias("weekday"),
        F.expr("md5(cast(o_orderkey as string))").alias("digest"),
        "o_orderdate",
    )
    found = {r["silver_column"]: (r["raw_column"], r["raw_form"], r["silver_form"]) for r in S.column_origins(raw, silver).collect()}
    assert found["order_no"] == ("o_orderkey", "value", "digits")
    assert found["customer"] == ("o_custkey", "value", "value")
    assert found["reference"] == ("ref", "tail", "value")
    assert found["price"] == ("o_totalprice", "value", "value")
    assert set(found) <= {"order_no", "customer", "reference", "price", "o_orderdate"}, "unrelated columns have no origin"


def test_merged_profile_is_the_profile_of_the_whole(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumns({"flag": F.col("value") > 1, "amount": F.col("value").cast("decimal(12,3)"), "day": F.to_date("ts"), "none": F.lit(None).cast("int")})
    path = str(tmp_path / "states")
    for month in (1, 2):
        # The second time replaces the first one's states.
        write_states(profile_states(events, "events", F.date_format("ts", "yyyy-MM-dd")), path)
    stored = spark.read.parquet(path)
    assert stored.select("part").distinct().count() > 1
    merged = {r["column"]: r for r in profile_of(merge_states(stored)).collect()}
    whole = {r["column"]: r for r in profile_table(events, "events").collect()}
    assert set(merged) == set(whole)
    for column, want in whole.items():
        found = merged[column]
        assert (found["dtype"], found["null_count"], found["min"], found["max"]) == (want["dtype"], want["null_count"], want["min"], want["max"]), column
        assert found["rows"] == events.count()
        assert abs(found["distinct_count"] - want["distinct_count"]) <= 0.06 * want["distinct_count"] + 0.5
    values = np.sort([r["value"] for r in events.collect() if r["value"] is not None])
    for rank, value in zip((0.25, 0.5, 0.75), merged["value"]["quartiles"], strict=True):
        assert abs(np.searchsorted(values, value) / len(values) - rank) < 0.02
    assert merged["none"]["quartiles"] is None and merged["event_type"]["quartiles"] is None


def test_bounds_of_large_numbers_are_exact(rows):
    states = profile_states(rows("n long, d decimal(20,5)", (9007199254740993, None), (-9223372036854775808, None), (None, None)), "t")
    found = {r["column"]: (r["min"], r["max"]) for r in profile_of(merge_states(states)).collect()}
    assert found == {"n": ("-9223372036854775808", "9007199254740993"), "d": (None, None)}
