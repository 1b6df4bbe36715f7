"""Joins with heavy keys give the rows of a plain join."""

import pytest
from pyspark.sql import functions as F

from tierloom.operators import joins as J


@pytest.fixture(scope="module")
def left(spark):
    # A third of the rows has one key, a sixth has none.
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(600).select("id", key.alias("key"))


@pytest.fixture(scope="module")
def right(spark):
    keys = spark.range(40).select(F.concat(F.lit("k"), F.col("id")).alias("right_key"), F.col("id").alias("value"))
    return keys.union(spark.createDataFrame([("hot", 1000), ("cold", 1)], keys.schema))


def collected(df):
    return sorted(map(tuple, df.select("id", "key", "value").collect()), key=str)


def test_heavy_keys_are_found(left):
    heavy = J.heavy_keys(left, ["key"], rows=50)["key"]
    assert heavy == {"hot": 200, None: 100}


def test_small_tables_have_no_heavy_keys(left):
    assert J.heavy_keys(left, ["key"]) == {"key": {}}


@pytest.mark.parametrize("heavy", [{"hot": 200, None: 100}, {"hot": 200}, {None: 100}, {"absent": 99, "k7": 12}, {}])
def test_spread_join_equals_plain_join(left, right, heavy):
    plain = left.join(right, left["key"] == right["right_key"], "left")
    spread = J.left_join(left, right, "key", "right_key", heavy, rows=20)
    assert spread.columns == plain.columns
    assert collected(spread) == collected(plain)


def test_repeated_right_keys_multiply_rows_once(left, right):
    doubled = right.union(right.withColumn("value", F.col("value") + 1))
    plain = left.join(doubled, left["key"] == doubled["right_key"], "left")
    spread = J.left_join(left, doubled, "key", "right_key", {"hot": 200, "k1": 10}, rows=30)
    assert collected(spread) == collected(plain)


@pytest.mark.parametrize("left_heavy", [{}, {"hot": 200, None: 100}, {"k1": 30}])
def test_heavy_right_keys_are_spread_too(left, right, left_heavy):
    copies = right.crossJoin(right.sparkSession.range(7).withColumnRenamed("id", "n"))
    many = copies.select("right_key", (copies["value"] * 10 + copies["n"]).alias("value"))
    plain = left.join(many, left["key"] == many["right_key"], "left")
    right_heavy = {"hot": 40, "k1": 30, "cold": 100, "k49": 100, "absent": 500, None: 9}
    spread = J.left_join(left, many, "key", "right_key", left_heavy, right_heavy, rows=10)
    assert spread.columns == plain.columns
    assert collected(spread) == collected(plain)


def test_spread_join_stays_an_equi_join(left, right, capsys):
    J.left_join(left, right, "key", "right_key", {"hot": 200, None: 100}, {"hot": 20}, rows=10).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("heavy, right_heavy, copied", [({"hot": 200}, {}, 1), ({}, {"hot": 20}, 1), ({"hot": 200}, {"k1": 30}, 2), ({}, {"absent": 99}, 0)])
def test_rows_are_copied_only_for_heavy_keys_of_the_other_side(left, right, heavy, right_heavy, copied, capsys):
    found = J.left_join(left, right, "key", "right_key", heavy, right_heavy, rows=10)
    found.explain()
    assert capsys.readouterr().out.count("Generate explode(") == copied
    assert collected(found) == collected(J.left_join(left, right, "key", "right_key"))


def test_heavy_rows_are_dealt_to_many_tasks(spark, left, right):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = J.left_join(left, right, "key", "right_key", {"hot": 200, None: 100}, rows=20)
        hot = spread.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        none = spread.where("key is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) > 3 and len(none) > 2


def test_pairs_of_a_key_heavy_on_both_sides_are_dealt_to_many_tasks(spark, left, right):
    many = right.crossJoin(spark.range(40).withColumnRenamed("id", "n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = J.left_join(left, many, "key", "right_key", {"hot": 200}, {"hot": 40}, rows=100)
        hot = spread.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) > 4 and sum(r["count"] for r in hot) == 200 * 40


def test_large_dimension_is_not_broadcast(left, right):
    joined = J.dimension_join(left, right, "key", "right_key", size=500, rows_per_task=15)
    assert collected(joined) == collected(J.dimension_join(left, right, "key", "right_key"))


def test_anti_join_distinct(rows):
    df = rows("k string, g string", ("a", "x"), ("a", "x"), ("b", "x"), (None, "y"))
    other = rows("k string", ("b",), (None,))
    got = J.anti_join_distinct(df, other, "k", ["k", "g"]).collect()
    assert sorted(map(tuple, got), key=str) == [("a", "x"), (None, "y")]


def test_cardinality_multiplies(rows):
    base = rows("a int, b int", (1, 1), (1, 2), (2, 9))
    first = rows("x int", (1,), (1,))
    second = rows("y int", (2,), (2,), (2,), (9,))
    got = J.join_cardinality(base, [("first", first, "a", "x"), ("second", second, "b", "y")]).collect()
    assert [(r["rows_before"], r["rows_after"]) for r in got] == [(3, 5), (5, 9)]


def test_copies_of_a_heavy_row_are_merged_and_come_back(spark, rows):
    left = rows("key string, v int", *[("hot", 1)] * 400, *[("hot", i) for i in range(40)], (None, 2), (None, 2), ("cold", 3))
    right = rows("right_key string, w int", ("hot", 10), ("cold", 11))
    spread = J.left_join(left, right, "key", "right_key", {"hot": 440, None: 2}, rows=20, repeated=True)
    plain = J.left_join(left, right, "key", "right_key")
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_heavy_keys_need_no_row_count(rows):
    df = rows("k string", *[("hot",)] * 50, *[(f"k{i}",) for i in range(50)])
    assert J.heavy_keys(df, ["k"], rows=20) == {"k": {"hot": 50}}
    assert J.heavy_keys(df, ["k"]) == {"k": {}}
    assert J.heavy_keys(df.limit(0), ["k"]) == {"k": {}}


def test_small_by_bytes(rows):
    df = rows("k string", *[("x" * 1000,)] * 20)
    assert J.is_small(df) and not J.is_small(df, size=10_000)


@pytest.mark.parametrize("heavy", [{"hot": 200, None: 100}, {}])
@pytest.mark.parametrize("right_heavy", [{"hot": 40, "k1": 30}, {}])
def test_copies_are_removed_in_the_shuffle_of_the_join(left, right, heavy, right_heavy, capsys):
    twice, both = left.union(left), right.union(right).union(right.withColumn("value", F.col("value") + 1))
    plain = left.join(both.distinct(), left["key"] == both["right_key"], "left")
    found = J.left_join(twice, both, "key", "right_key", heavy, right_heavy, rows=20, distinct_left=True, distinct_right=True)
    assert collected(found) == collected(plain)
    found.explain()
    assert "hashpartitioning(id" not in capsys.readouterr().out, "no shuffle by all columns"
