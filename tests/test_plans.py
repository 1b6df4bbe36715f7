"""Physical plans keep the shape that holds at scale."""

import contextlib
import io
import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tierloom.operators import joins as J


def physical_plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def plan(spark, sf_dir):
    return lambda name: physical_plan(entry_point.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["silver_contact_employments", "silver_contact_phones", "latest_log_per_referral", "latest_lead_record"])
def test_best_row_is_reduced_before_the_shuffle(plan, name):
    text = plan(name)
    partial, shuffle = text.index("row_number(), 1, Partial"), text.index("Exchange hashpartitioning")
    assert shuffle < partial, "the partial limit lies below the exchange"


def test_report_has_no_nested_loop_and_no_python(plan):
    text = plan("referral_report")
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "EvalPython" not in text


@pytest.mark.parametrize("name", ["gold_contacts_without_phone", "business_rules", "contract_all_rules", "run_checks"])
def test_no_python_in_plans(plan, name):
    assert not re.search("EvalPython|MapInPandas|FlatMapGroups", plan(name))


def test_anti_join_is_an_anti_join(plan):
    assert "LeftAnti" in plan("anti_join_no_phone")


def test_scan_reads_only_needed_columns(plan):
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan("order_by_metric_desc")))
    assert schema == "o_orderpriority:string"


def test_row_checks_share_one_scan(plan):
    assert plan("contract_not_null").count("FileScan") == 1


def test_shuffled_rows_are_not_put_into_a_hash_map(spark):
    """Copies of a row take few bytes in a shuffle and many in a hash map, which cannot spill."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(2000).select((F.col("id") % 9).alias("key"), F.lit("wide " * 50).alias("text"))
        joined = J.left_join(left, spark.range(9).withColumnRenamed("id", "right_key"), "key", "right_key")
        assert len(joined.collect()) == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
