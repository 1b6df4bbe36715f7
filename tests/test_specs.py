"""Layer steps and checks from YAML text."""

import pytest
from pyspark.sql import functions as F

from tierloom.operators import quality as Q
from tierloom.operators.contracts import ContractBroken, load_contract, rule_predicates
from tierloom.plans.specs import SpecBroken, load_checks, load_spec
from tierloom.sources.writers import ChecksFailed, materialize_layer

STEP = """
dag: {dag_id: phones}
source: {database: bronze, table: phones_raw}
target: {database: silver, table: contact_phones}
processing: {deduplicate: %s, remove_pii_masking: %s, normalize_phone_numbers: true}
"""
COLUMNS = "contact_id string, label string, number string, organization_id string, processing_date date"


@pytest.fixture
def raw(rows, tmp_path):
    from datetime import date

    day = date(2026, 3, 1)
    rows(COLUMNS, ("a", "X", "+1 555 1234567", "org", day), ("a", "X", "1-555-1234567", "org", day), ("b", "Y", "7654321", "org_pii_masking", day)).write.parquet(str(tmp_path / "raw"))
    return {"bronze.phones_raw": str(tmp_path / "raw"), "silver.contact_phones": str(tmp_path / "silver")}


@pytest.mark.parametrize(("deduplicate", "masked", "left"), [("true", "true", 1), ("true", "false", 2), ("false", "false", 3), ("false", "true", 2)])
def test_flags_switch_steps(spark, raw, deduplicate, masked, left):
    materialize_layer(spark, load_spec(STEP % (deduplicate, masked), locations=raw))
    assert spark.read.parquet(raw["silver.contact_phones"]).count() == left


def test_failing_check_leaves_the_old_target(spark, raw):
    checks = 'tests: [{name: few, query: "SELECT COUNT(*) FROM silver.contact_phones", condition: "< 2"}]'
    materialize_layer(spark, load_spec(STEP % ("true", "true"), checks, locations=raw))
    with pytest.raises(ChecksFailed, match="few: 2, not < 2"):
        materialize_layer(spark, load_spec(STEP % ("true", "false"), checks, locations=raw))
    assert spark.read.parquet(raw["silver.contact_phones"]).count() == 1


def test_unknown_names_stop(spark):
    with pytest.raises(SpecBroken, match="flags"):
        load_spec((STEP % ("true", "true")).replace("deduplicate", "dedup"))
    with pytest.raises(SpecBroken, match="no transform"):
        load_spec((STEP % ("true", "true")).replace("contact_phones", "faxes"))
    with pytest.raises(SpecBroken, match="unique"):
        load_checks("tests: [{column: a, tests: [unique]}]")
    with pytest.raises(SpecBroken):
        load_checks("tests: [{name: nothing}]")


def test_query_checks(rows):
    df = rows("k string, v int", ("a", 1), ("a", 2), ("b", None))
    text = """
tests:
  - {name: single, query: "SELECT COUNT(*) FROM db.t WHERE match(k, '^a$')", condition: "= 2"}
  - {name: groups, query: "SELECT k, COUNT(*) FROM db.t GROUP BY k HAVING COUNT(*) > 1", condition: "= 0"}
  - {column: v, tests: [not_null]}
"""
    got = {r["check"]: (r["observed"], r["passed"]) for r in Q.run_checks(df, load_checks(text, "db.t")).collect()}
    assert got == {"single": (2, True), "groups": (1, False), "v_not_null": (1, False)}


def test_unknown_quality_rule_stops(spark):
    contract = load_contract("table: t\ncolumns: [{name: a, type: string}]\ndata_quality_rules: [{name: surprise, columns: [a]}]")
    with pytest.raises(ContractBroken, match="surprise"):
        rule_predicates(contract)
    contract = load_contract("table: t\ncolumns: [{name: a, type: string}]\ndata_quality_rules: [{name: valid_email_format, columns: [a]}]")
    with pytest.raises(ContractBroken, match="email_format"):
        rule_predicates(contract)


def test_full_refresh_removes_old_partitions_and_reads_orc(spark, rows, tmp_path):
    from tierloom.sources.writers import TransformSpec

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spec = TransformSpec("copy", {"s": source}, target, lambda s: s, partition_by=["day"], source_formats={"s": "orc"})
    for day in ("2026-03-01", "2026-03-20"):
        rows("k string, day string", ("a", day)).write.mode("overwrite").orc(source)
        materialize_layer(spark, spec)
    assert [tuple(r) for r in spark.read.parquet(target).select("k", F.col("day").cast("string")).collect()] == [("a", "2026-03-20")]
