"""Profiles and layer comparisons on hand-written rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierloom.operators import reconcile as X
from tierloom.operators.profile import profile_table


@pytest.fixture
def raw(rows):
    return rows("id int, rate double, called string, flag string", (1, 0.01, None, "true"), (2, 0.02, None, "x"), (3, 0.03, "2024", None))


@pytest.fixture
def silver(rows):
    return rows("flag string, id int, rate double, called int", ("true", 1, 1.0, 0), ("false", 2, 2.0, 0), ("false", 9, 3.0, None))


def test_profile(rows):
    df = rows(
        "n int, s string, updated_at string, t timestamp",
        (1, "a", "2024-01-02", datetime(2024, 1, 1)),
        (5, "a", "2024-01-01", None),
        (None, None, None, None),
    )
    got = {r["column"]: tuple(r)[2:] for r in profile_table(df, "t", infer_dates=True).collect()}
    assert got["n"] == ("int", 1, 2, "1", "5")
    assert got["s"] == ("string", 1, 1, None, None)
    assert got["updated_at"] == ("string", 1, 2, "2024-01-01 00:00:00.000000", "2024-01-02 00:00:00.000000")
    assert got["t"] == ("timestamp", 2, 1, "2024-01-01 00:00:00.000000", "2024-01-01 00:00:00.000000")
    approximate = {r["column"]: r["distinct_count"] for r in profile_table(df, "t", approximate=True).collect()}
    assert approximate == {"n": 2, "s": 1, "updated_at": 2, "t": 1}


def test_null_rates(raw, silver):
    got = {r["column"]: (r["raw_null_rate"], r["silver_null_rate"]) for r in X.null_rate_by_layer(raw, silver).collect()}
    assert got["called"] == (2 / 3, 1 / 3) and got["id"] == (0.0, 0.0)


def test_defaults_that_replaced_nulls(raw, silver):
    got = X.nulls_became_default(raw, silver, ["id"], ["called", "rate"]).collect()
    assert {r["column"]: r["defaulted"] for r in got} == {"called": 2, "rate": 0}


def test_scale(raw, silver):
    row = X.scale_drift(raw, silver, ["rate"], ["id"]).first()
    assert row["median_ratio"] == pytest.approx(100.0) and (row["raw_max"], row["silver_max"]) == (0.03, 3.0)
    assert "median_ratio" not in X.scale_drift(raw, silver, ["rate"]).columns


def test_keys(raw, silver):
    row = X.key_traceability(raw, silver, ["id"]).first()
    assert tuple(row) == (1, 1, 2, 2 / 3)


def test_flags(raw):
    got = {r["value"]: r["expected"] for r in X.boolean_domain(raw, ["flag"]).collect()}
    assert got == {"true": True, "x": False, None: False}


def test_schema_diff(raw, silver):
    got = {tuple(r) for r in X.schema_diff(raw.drop("rate"), silver).collect()}
    assert ("rate", "added", None, "double") in got and ("called", "type", "string", "int") in got
    assert ("flag", "moved", "2", "0") in got and ("id", "moved", "0", "1") in got


def test_lineage(raw):
    out = X.add_lineage_columns(raw, "raw", "called", F.lit("2026-01-01").cast("timestamp"), first=["flag"])
    assert out.columns == ["flag", "id", "rate", "called", "_loaded_at", "_source_table", "_source_timestamp"]


def test_layer_counts(raw, silver):
    got = X.layer_row_counts({"raw": raw, "silver": silver.limit(2)}, {"top": F.max("id")}).collect()
    assert [tuple(r) for r in got] == [("raw", 3, 3), ("silver", 2, 2)]


def test_repeated_keys_make_no_pairs(rows):
    raw = rows("k string, v double", ("a", 2.0), ("a", 4.0), ("b", 5.0), (None, 1.0), ("c", None))
    silver = rows("k string, v double", ("a", 2.0), ("a", 4.0), ("b", 50.0), (None, 1.0), ("c", 0.0))
    # Key a has several values in both layers: its two raw rows have the ratio of the means.
    assert X.scale_drift(raw, silver, ["v"], ["k"]).first()["median_ratio"] == 1.0
    assert X.scale_drift(raw.where("k = 'b'"), silver, ["v"], ["k"]).first()["median_ratio"] == 10.0
    assert X.nulls_became_default(raw, silver, ["k"], ["v"]).first()["defaulted"] == 1
    got = {r["layer"]: (r["keys"], r["rows"]) for r in X.repeated_keys(raw, silver, ["k"]).collect()}
    assert got == {"raw": (1, 2), "silver": (1, 2)}


def test_profile_of_flags_and_declared_dates(rows):
    df = rows("f boolean, d string, e boolean", (True, "2024-02-01", None), (False, "2024-01-01", None), (None, None, None))
    got = {r["column"]: (r["min"], r["max"], r["distinct_count"]) for r in profile_table(df, "t", dates=["d"]).collect()}
    assert got["f"] == ("false", "true", 2) and got["e"] == (None, None, 0)
    assert got["d"][0].startswith("2024-01-01") and got["d"][1].startswith("2024-02-01")


def test_rows_of_repeated_keys_are_compared(rows):
    raw = rows("k string, v double", *[("hot", 2.0)] * 5, *[("hot", None)] * 3, ("a", 4.0), ("a", None), ("b", 1.0), (None, None))
    silver = rows("k string, v double", ("hot", 200.0), ("a", 0.0), ("b", 1.0), ("b", 1.0), (None, 0.0))
    assert X.scale_drift(raw, silver, ["v"], ["k"]).first()["median_ratio"] == 100.0
    assert X.nulls_became_default(raw, silver, ["k"], ["v"]).first()["defaulted"] == 1
    holds = rows("k string, v double", ("hot", 0.0), ("hot", 7.0), ("a", 0.0))
    assert X.nulls_became_default(raw, holds, ["k"], ["v"]).first()["defaulted"] == 4


def test_silver_values_meet_the_one_raw_value(rows):
    raw = rows("k string, v double", ("a", 2.0), ("a", 2.0), ("b", 1.0), ("b", 3.0))
    silver = rows("k string, v double", ("a", 20.0), ("a", 20.0), ("a", 40.0), ("b", 7.0), ("b", 8.0))
    assert X.scale_drift(raw, silver, ["v"], ["k"]).first()["median_ratio"] == 10.0
    assert X.undecided_keys(raw, silver, ["k"], ["v"]).first()["keys"] == 1


def test_a_heavy_key_has_a_ratio_for_every_row(rows):
    raw = rows("k int, j int, v double", *[(1, 1, float(i % 7 + 1)) for i in range(300)], *[(i, 2, 1.0) for i in range(40)])
    silver = rows("k int, j int, v double", (1, 1, 5.0), *[(i, 2, 3.0) for i in range(40)])
    assert X.scale_drift(raw, silver, ["v"], ["k", "j"]).first()["median_ratio"] == 1.25


def ratios_of(raw, silver):
    """Ratios of one column by plain loops: raw and silver are lists of (key, value)."""
    out = []
    for key in {k for k, _ in raw} & {k for k, _ in silver} - {None}:
        a, b = ([v for k, v in side if k == key and v is not None and v == v] for side in (raw, silver))
        if len(set(b)) == 1:
            out += [b[0] / v for v in a if v]
        elif len(set(b)) > 1 and len(set(a)) == 1:
            out += [v / a[0] for v in b if a[0]]
        elif len(set(b)) > 1 and len(set(a)) > 1 and sum(a):
            out += [sum(b) / len(b) / (sum(a) / len(a))] * len(a)
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_ratios_against_plain_loops(rows, seed):
    import random

    pick = random.Random(seed)
    side = lambda factor, n: [(pick.choice([None, 1, 2, 3, 4, 5, 5, 5]), pick.choice([None, 0.0, float("nan"), *[pick.randint(-3, 9) * factor for _ in range(9)]])) for _ in range(n)]
    raw, silver = side(1.0, 40), side(100.0, pick.choice([3, 8, 40]))
    found = X.scale_drift(rows("k int, v double", *raw), rows("k int, v double", *silver), ["v"], ["k"], digits=12).first()
    want = ratios_of(raw, silver)
    assert found["median_ratio"] == (pytest.approx(want[-(-len(want) // 2) - 1]) if want else None)


def test_several_columns_and_none_in_common(rows):
    raw, silver = rows("k int, a double, b int", (1, 2.0, 3), (2, None, 5)), rows("k int, a double, b int", (3, 4.0, 3), (2, 1.0, 50))
    found = {r["column"]: r for r in X.scale_drift(raw, silver, ["a", "b"], ["k"]).collect()}
    assert found["b"]["median_ratio"] == 10.0 and found["a"]["median_ratio"] is None
    assert (found["a"]["raw_max"], found["a"]["silver_min"], found["b"]["silver_max"]) == (2.0, 1.0, 50.0)
