"""Rows with the rules they break, JSON of unknown shape, keyed pseudonyms."""

import hashlib
import hmac
import os

import pytest
from pyspark.sql import functions as F

from tierloom.functions import hmac_sha256, pseudonymize_address
from tierloom.operators import contracts as K, json_shapes as J, quarantine as Q


@pytest.fixture
def rules(spark):
    return [
        ("not_null", "a", F.col("a").isNull()),
        ("range", "n", ~F.col("n").between(0, 9)),
        ("pattern", "a", ~F.col("a").rlike("^x")),
    ]


ROWS = [(1, "x", 5), (2, None, 50), (3, "y", None), (4, "y", -1), (5, "x", None)]


@pytest.fixture
def table(rows):
    return rows("id int, a string, n int", *ROWS)


def test_rows_and_counts(spark, table, rules, tmp_path):
    split = Q.split_rows(table, rules, str(tmp_path / "split"))
    assert sorted(r["id"] for r in split.good.collect()) == [1, 5] and split.good.columns == ["id", "a", "n"]
    assert {r["id"]: r[Q.BROKEN] for r in split.quarantine.collect()} == {2: ["not_null:a", "range:n"], 3: ["pattern:a"], 4: ["range:n", "pattern:a"]}
    assert sorted(map(tuple, split.counts.collect())) == sorted(map(tuple, K.check_rules(table, rules).collect()))


def test_one_scan_and_one_write(spark, table, rules, tmp_path):
    source = str(tmp_path / "in")
    table.write.parquet(source)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("split", "split")
    try:
        Q.split_rows(spark.read.schema(table.schema).parquet(source), rules, str(tmp_path / "split"))
        assert len(jobs.getJobIdsForGroup("split")) == 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    plan = Q.with_broken_rules(spark.read.parquet(source), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_second_run_replaces_the_first(spark, table, rules, tmp_path):
    path = str(tmp_path / "split")
    Q.split_rows(table, rules, path)
    split = Q.split_rows(table.where("id = 1"), rules, path)
    assert split.good.count() == 1 and split.quarantine.count() == 0


def test_a_failing_run_leaves_the_first(spark, table, rules, tmp_path):
    path = str(tmp_path / "split")
    Q.split_rows(table, rules, path)
    with pytest.raises(Exception, match="dies"):
        Q.split_rows(table.withColumn("n", F.expr("if(id = 3, raise_error('dies'), n)").cast("int")), rules, path)
    assert spark.read.parquet(path).count() == len(ROWS)


def test_no_rows_and_no_rules(spark, table, rules, tmp_path):
    empty = Q.split_rows(table.where("false"), rules, str(tmp_path / "empty"))
    assert empty.good.count() == empty.quarantine.count() == 0 and {r["violations"] for r in empty.counts.collect()} == {0}
    assert Q.split_rows(table, [], str(tmp_path / "all")).good.count() == len(ROWS)


JSON = ['{"a": 1, "b": {"c": [1, "x"]}}', '{"a": "t"}', "[1, 2]", "5", "null", None, "", "{", '{"a": 1} x', '{"a": 1, "a": 2}']


def test_json_report_and_fields(rows):
    table = rows("j string", *[(j,) for j in JSON])
    report = J.json_report(table, "j").first()
    assert (report["rows"], report["nulls"], report["bad"]) == (10, 1, 4), "a repeated key is no valid JSON here"
    found = {(r["path"], r["type"]): r["values"] for r in J.json_fields(table, "j").collect()}
    assert found[("$", "OBJECT")] == 2 and found[("$", "ARRAY")] == 1 and found[("$", "BIGINT")] == 1 and found[("$", "VOID")] == 1
    assert found[("$.a", "BIGINT")] == 1 and found[("$.a", "STRING")] == 1 and found[("$.b.c", "ARRAY")] == 1
    assert found[("$.b.c[*]", "STRING")] == 1 and found[("$[*]", "BIGINT")] == 2
    assert not any(path.startswith("$.b.c") for path, _ in {(r["path"], r["type"]) for r in J.json_fields(table, "j", depth=1).collect()})


def test_json_columns(rows):
    table = rows("j string, a string", *[(j, "kept") for j in JSON])
    found = J.with_json_fields(table, "j", {"n": ("$.a", "int"), "c": ("$.b.c[1]", "string")}, bad="bad").collect()
    assert [r["n"] for r in found[:4]] == [1, None, None, None] and found[0]["c"] == "x" and {r["a"] for r in found} == {"kept"}
    assert [r["bad"] for r in found] == [False] * 6 + [True] * 4


# Key, data and digest of the published test cases 1, 2, 3, 6 and 7.
VECTORS = [
    (b"\x0b" * 20, b"Hi There", "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
    (b"Jefe", b"what do ya want for nothing?", "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
    (b"\xaa" * 20, b"\xdd" * 50, "773ea91e36800e46854db8ebd09181a72959098b3ef8c122d9635514ced565fe"),
    (b"\xaa" * 131, b"Test Using Larger Than Block-Size Key - Hash Key First", "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
    (
        b"\xaa" * 131,
        b"This is a test using a larger than block-size key and a larger than block-size data. The key needs to be hashed before being used by the HMAC algorithm.",
        "9b09ffa71b942fcb27635fbcd5b0e944bfdc63644f0713938a7f51535c3a35e2",
    ),
]


@pytest.mark.parametrize(("key", "data", "digest"), VECTORS)
def test_published_digests(rows, key, data, digest):
    assert rows("b binary", (data,)).select(hmac_sha256(F.col("b"), key)).first()[0] == digest


def test_digests_of_random_texts(rows):
    for size in (0, 1, 63, 64, 65, 200):
        key, data = os.urandom(size), os.urandom(size * 3)
        assert rows("b binary", (data,)).select(hmac_sha256(F.col("b"), key)).first()[0] == hmac.new(key, data, hashlib.sha256).hexdigest()


def test_addresses(rows):
    table = rows("a string", ("Ann@x.org",), (" ann@X.org ",), ("ann@y.org",), ("no address",), (None,), ("a@b@x.org",))
    plain = [r[0] for r in table.select(pseudonymize_address(F.col("a"), b"key")).collect()]
    assert plain[0] == plain[1] and plain[0].endswith("@x.org") and plain[2].endswith("@y.org") and plain[5].endswith("@x.org")
    assert plain[0].split("@")[0] != plain[2].split("@")[0] and "@" not in plain[3] and plain[4] is None
    hidden = [r[0] for r in table.select(pseudonymize_address(F.col("a"), b"key", hide_domain=True)).collect()]
    assert "x.org" not in hidden[0] and hidden[0].split("@")[1] == hidden[5].split("@")[1] != hidden[2].split("@")[1]
    other = [r[0] for r in table.select(pseudonymize_address(F.col("a"), b"other key")).collect()]
    assert other[0] != plain[0]
