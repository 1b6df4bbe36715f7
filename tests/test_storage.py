"""Readers, writers, reruns and the two email loads."""

import json
import time
from datetime import datetime

import pytest
from pyspark.sql import Observation, functions as F, types as T

from tierloom.operators import contracts as K, quality
from tierloom.plans import emails as M
from tierloom.session import scratch_dir
from tierloom.sources import readers, writers
from tierloom.sources.readers import scan_csv
from tierloom.sources.writers import insert_if_absent

THREAD = "aa001-aaaaaaaa-bbbb-cccc-dddd-eeeeeeeeee{:02d}"


def email(**changes):
    row = {
        "subject": " hello ", "sender": "a@x.org", "receiver": "b@x.org", "timestamp": "2026-01-01 05:00:00+07:00",
        "message_body": 'two lines\nand a "quote", a comma', "thread_id": THREAD.format(1), "email_types": '["inquiry"]',
        "email_status": "ongoing", "email_criticality": "low", "product_types": '["IAM service"]',
        "agent_effectivity": "high", "agent_efficiency": "very low", "customer_satisfaction": "0.5",
    }
    return tuple((row | changes)[c] for c in M.EMAIL_COLUMNS)


@pytest.fixture
def emails(rows):
    schema = ", ".join(f"`{c}` string" for c in M.EMAIL_COLUMNS)
    return lambda *values: rows(schema, *values)


@pytest.fixture
def csv(tmp_path):
    import csv as writer

    def write(*values, header=M.EMAIL_COLUMNS):
        path = tmp_path / "emails.csv"
        with open(path, "w", newline="") as file:
            out = writer.writer(file)
            out.writerow(header)
            out.writerows(values)
        return str(path)

    return write


def test_missing_input_stops_first(spark, tmp_path):
    with pytest.raises(readers.InputMissing):
        readers.gate_input_exists(spark, str(tmp_path / "none.csv"))
    with pytest.raises(readers.InputMissing):
        M.ingest_emails_table(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"), multi_line=True)


def test_scan_csv_types_and_missing_words(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,name,at,ok,n\n1,null,2024-01-01T00:00:00Z,TRUE,1.5\nx,"say ""hi""",bad,no,NA\n3,  NA,,false,\n')
    schema = T.StructType.fromDDL("id int, name string, at timestamp, ok boolean, n double")
    got = [tuple(r) for r in readers.scan_csv(spark, str(path), schema).collect()]
    assert got == [
        (1, None, datetime(2024, 1, 1), True, 1.5),
        (None, 'say "hi"', None, False, None),
        (3, "  NA", None, False, None),
    ]


def test_file_order_follows_the_file(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("k\n" + "\n".join(str(i) for i in range(2000)) + "\n")
    df = readers.scan_csv(spark, str(path), file_order=True).repartition(5)
    assert [int(r["k"]) for r in df.orderBy(readers.FILE_ORDER).collect()] == list(range(2000))


def test_first_load(spark, csv, tmp_path):
    target = str(tmp_path / "table")
    path = csv(
        email(subject="first"),
        email(subject="second"),
        email(thread_id=THREAD.format(2), email_status=" DONE "),
        email(thread_id=THREAD.format(3), email_status=""),
    )
    for _ in range(2):
        M.ingest_emails_table(spark, path, target, multi_line=True)
    got = {r["thread_id"]: r for r in spark.read.parquet(target).collect()}
    assert set(got) == {THREAD.format(1), THREAD.format(3)}, "done is dropped, a missing status stays"
    first = got[THREAD.format(1)]
    assert first["subject"] == "first" and first["message_body"] == 'two lines\nand a "quote", a comma'
    assert first["timestamp"] == datetime(2025, 12, 31, 22) and str(first["customer_satisfaction"]) == "0.5000000000"


def test_new_threads_are_added_and_held_ones_stay(spark, csv, tmp_path):
    target = str(tmp_path / "table")
    M.ingest_emails_table(spark, csv(email(subject="old")), target, multi_line=True)
    M.ingest_emails_table(spark, csv(email(subject="new"), email(thread_id=THREAD.format(2), subject="new")), target, multi_line=True)
    got = {r["thread_id"]: r["subject"] for r in spark.read.parquet(target).collect()}
    assert got == {THREAD.format(1): "old", THREAD.format(2): "new"}


def test_load_into_a_catalog_table(spark, csv):
    spark.sql("CREATE DATABASE IF NOT EXISTS care")
    for _ in range(2):
        M.ingest_emails_table(spark, csv(email(), email(thread_id=THREAD.format(2))), "care.emails", multi_line=True)
    assert spark.table("care.emails").count() == 2
    assert spark.table("care.emails").columns == list(M.EMAIL_COLUMNS)
    spark.sql("DROP TABLE care.emails")


def test_missing_required_value_fails_before_anything_is_stored(spark, csv, tmp_path):
    target = str(tmp_path / "table")
    with pytest.raises(Exception, match="null in sender"):
        M.ingest_emails_table(spark, csv(email(), email(thread_id=THREAD.format(2), sender="")), target, multi_line=True)
    with pytest.raises(Exception):
        spark.read.parquet(target)


def test_wrong_columns_stop_the_first_load(spark, csv, tmp_path):
    swapped = ("sender", "subject", *M.EMAIL_COLUMNS[2:])
    with pytest.raises(K.ContractBroken):
        M.ingest_emails_table(spark, csv(email(), header=swapped), str(tmp_path / "t"), multi_line=True)


def test_second_load_takes_any_column_order(spark, csv, tmp_path):
    swapped = ("sender", "subject", *M.EMAIL_COLUMNS[2:])
    dropped = Observation("dropped")
    path = csv(email(), email(timestamp="bad"), email(timestamp="2026-02-01 05:00:00+07:00"), header=swapped)
    out = M.ingest_emails_partitioned(spark, path, str(tmp_path / "bucket"), multi_line=True, dropped=dropped)
    assert out.endswith("/bucket/customer_care_emails")
    got = spark.read.parquet(out)
    assert {(r["year"], r["month"]) for r in got.collect()} == {(2025, 12), (2026, 1)}
    assert dropped.get == {"dropped_rows": 1}
    with pytest.raises(K.ContractBroken, match="unexpected columns"):
        M.ingest_emails_partitioned(spark, csv(email(), header=("other", *M.EMAIL_COLUMNS[1:])), str(tmp_path / "b2"), multi_line=True)


def test_rerun_replaces_only_its_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    writers.write_partitioned_parquet(rows("v int, year int, month int", (1, 2024, 1), (2, 2024, 2)), path)
    writers.write_partitioned_parquet(rows("v int, year int, month int", (9, 2024, 2)), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 9]


def test_partition_columns_must_be_there(rows, tmp_path):
    with pytest.raises(ValueError, match="month"):
        writers.write_partitioned_parquet(rows("year int", (1,)), str(tmp_path / "out"))


def test_null_key_is_refused(rows, tmp_path):
    with pytest.raises(Exception, match="null in k"):
        writers.insert_if_absent(rows("k string, v int", (None, 1)), str(tmp_path / "t"), ["k"], ["v"])


def test_layer_into_catalog_tables(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS refined")
    rows("k int", (1,), (1,), (2,)).write.mode("overwrite").saveAsTable("refined.raw")
    spec = writers.TransformSpec(
        "t",
        {"df": "refined.raw"},
        "refined.counted",
        lambda df: df.groupBy("k").count(),
        fmt="orc",
        checks=[quality.row_count(), quality.no_duplicates(["count"], "counts_differ")],
    )
    for _ in range(2):
        writers.materialize_layer(spark, spec)
    assert [r["passed"] for r in writers.check_layer(spark, spec).collect()] == [True, True]
    assert sorted(map(tuple, spark.table("refined.counted").collect())) == [(1, 2), (2, 1)]


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


# --- contracts --------------------------------------------------------------------------------------------

BROKEN = {
    ("not_null", "subject"): {"subject": None},
    ("max_length", "subject"): {"subject": "x" * 501},
    ("max_length", "sender"): {"sender": "a@x." + "o" * 255},
    ("email_format", "sender"): {"sender": "no address"},
    ("email_format", "receiver"): {"receiver": "a@b"},
    ("timestamp_format", "timestamp"): {"timestamp": "2026-01-01T05:00"},
    ("max_length", "message_body"): {"message_body": "x" * 10001},
    ("non_blank", "message_body"): {"message_body": " \n\t"},
    ("pattern", "thread_id"): {"thread_id": "bb001"},
    ("array_allowed", "email_types"): {"email_types": '["inquiry", "spam"]'},
    ("array_allowed", "product_types"): {"product_types": "IAM service"},
    ("allowed_values", "email_status"): {"email_status": "done"},
    ("allowed_values", "email_criticality"): {"email_criticality": "Low"},
    ("allowed_values", "agent_effectivity"): {"agent_effectivity": "best"},
    ("allowed_values", "agent_efficiency"): {"agent_efficiency": ""},
    ("range", "customer_satisfaction"): {"customer_satisfaction": "1.01"},
    ("timestamp_in_past", "timestamp"): {"timestamp": "2026-03-01 05:00:00+0700"},
}


@pytest.mark.parametrize("rule", BROKEN, ids="-".join)
def test_each_rule_counts_its_broken_row(emails, rule):
    df = emails(email(), email(**BROKEN[rule]))
    found = {(r["rule"], r["column"]): r["violations"] for r in K.check_contract(df, M.DATASET_CONTRACT, datetime(2026, 2, 15)).collect()}
    assert {k: v for k, v in found.items() if v} == {rule: 1}


def test_primary_key(emails):
    found = K.check_primary_key(emails(email(), email(), email(thread_id="x")), ["thread_id"]).first()
    assert (found["violations"], found["passed"]) == (1, False)


CONTRACT = {
    "dataset_name": "mails",
    "primary_key": ["id"],
    "columns": [
        {"name": "id", "type": "LowCardinality(String)", "nullable": False, "max_length": 3},
        {"name": "seen", "type": "Nullable(Date)"},
        {"name": "tags", "type": "array", "item_type": "string", "allowed_values": ["a", "b"], "nullable": False},
        {"name": "n", "type": "UInt64"},
    ],
    "data_quality_rules": [{"name": "timestamp_in_past", "columns": ["seen"]}],
}


def test_contract_from_text():
    contract = K.load_contract(json.dumps(CONTRACT))
    assert contract.names == ["id", "seen", "tags", "n"] and contract.primary_key == ("id",)
    assert [c.nullable for c in contract.columns] == [False, True, False, False]
    fields = contract.struct().fields
    assert [f.dataType.simpleString() for f in fields] == ["string", "date", "array<string>", "bigint"]
    assert fields[0].metadata["max_length"] == 3


def test_type_mismatches(rows):
    contract = K.contract_from(CONTRACT)
    df = rows("id string, seen string, tags array<string>, n int", ("a", None, ["a"], 1))
    assert K.type_mismatches(df, contract) == [("seen", "date", "string"), ("n", "bigint", "int")]


def test_column_sets(rows):
    contract = K.contract_from(CONTRACT)
    shuffled = rows("n int, id string, seen string, tags string")
    assert K.check_columns_set(shuffled, contract) is shuffled
    with pytest.raises(K.ContractBroken):
        K.check_columns_ordered(shuffled, contract)
    with pytest.raises(K.ContractBroken, match="missing columns \\['id'\\]"):
        K.check_columns_set(shuffled.drop("id"), contract)


# --- files with other headers, loads that died ----------------------------------------------------------


def _files(folder, *texts):
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"{i}.csv").write_text(text)
    return str(folder)


def test_files_with_another_column_order_are_read_by_name(spark, tmp_path):
    path = _files(tmp_path / "in", "id,name,city\n1,ann,rome\n", "id,city,name\n2,oslo,bob\n", "id,name,city\n3,cid,bern\n")
    got = scan_csv(spark, path, by_name=True).orderBy("id").collect()
    assert [(r["id"], r["name"], r["city"]) for r in got] == [("1", "ann", "rome"), ("2", "bob", "oslo"), ("3", "cid", "bern")]


def test_files_with_another_column_order_stop_a_plain_scan(spark, tmp_path):
    path = _files(tmp_path / "in", "id,name,city\n1,ann,rome\n", "id,city,name\n2,oslo,bob\n")
    with pytest.raises(Exception, match="1.csv"):
        scan_csv(spark, path).collect()


def test_a_file_without_a_column_is_named(spark, tmp_path):
    path = _files(tmp_path / "in", "id,name\n1,ann\n", "id\n2\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    with pytest.raises(ValueError, match="1.csv"):
        scan_csv(spark, path, schema, by_name=True)


def test_rerun_after_a_first_load_that_died(spark, rows, tmp_path):
    target = tmp_path / "t"
    (target / "_temporary" / "0").mkdir(parents=True)
    batch = rows("k string, v int", ("a", 1), ("b", 2))
    for _ in range(2):
        insert_if_absent(batch, str(target), ["k"], ["v"])
    assert sorted(map(tuple, spark.read.parquet(str(target)).collect())) == [("a", 1), ("b", 2)]


def test_only_partitions_of_the_batch_are_compared(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    insert_if_absent(rows("k string, day string", ("a", "d1"), ("b", "d2")), target, ["k"], ["day"], partition="day")
    insert_if_absent(rows("k string, day string", ("a", "d1"), ("c", "d1")), target, ["k"], ["day"], partition="day")
    got = spark.read.parquet(target).select("k", "day").collect()
    assert sorted(map(tuple, got)) == [("a", "d1"), ("b", "d2"), ("c", "d1")]


@pytest.mark.parametrize("unknown", [None, ""])
def test_rerun_with_null_partition_values(spark, rows, tmp_path, unknown):
    target = str(tmp_path / "t")
    batch = rows("k string, day string", ("a", "d1"), ("b", unknown), ("c", unknown))
    for _ in range(3):
        insert_if_absent(batch, target, ["k"], ["day"], partition="day")
    insert_if_absent(rows("k string, day string", ("d", "d1"), ("a", "d1")), target, ["k"], ["day"], partition="day")
    got = spark.read.schema("k string, day string").parquet(target).collect()
    assert sorted(map(tuple, got), key=str) == [("a", "d1"), ("b", None), ("c", None), ("d", "d1")]


def test_rerun_with_null_dates_as_partitions(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    batch = rows("k string, d string", ("a", "2024-01-02"), ("b", None)).selectExpr("k", "cast(d as date) as day")
    for _ in range(2):
        insert_if_absent(batch, target, ["k"], ["day"], partition="day")
    assert spark.read.parquet(target).count() == 2


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


@pytest.mark.parametrize("write", [writers.stored, lambda df: writers.write_report_csv(df, f"{scratch_dir(df.sparkSession)}/report")])
def test_shuffle_files_go_when_a_table_is_stored(spark, write):
    """They are removed in the background."""
    before = shuffle_files(spark)
    write(spark.range(1000).groupBy((F.col("id") % 100).alias("key")).count())
    assert spark.conf.get(writers.DROP_SHUFFLES) == "false"
    ends = time.time() + 20
    while shuffle_files(spark) - before and time.time() < ends:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_csv_of_a_table_that_shuffles_leaves_nothing_aside(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "scratch_dir", lambda spark: str(tmp_path / "aside"))
    path = writers.write_report_csv(spark.range(10).groupBy((F.col("id") % 2).alias("odd")).count(), str(tmp_path / "report"))
    assert sorted(map(tuple, spark.read.csv(path, header=True).collect())) == [("0", "5"), ("1", "5")]
    assert [p.name for p in tmp_path.iterdir()] == ["report"]
