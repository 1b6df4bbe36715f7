"""Steps from SQL text: names, functions, refusals, and targets that survive a run that dies."""

import pytest

from tierloom.plans import sql_steps
from tierloom.plans.specs import SpecBroken, load_spec
from tierloom.plans.sql_steps import QueryBroken, run_query
from tierloom.sources import writers
from tierloom.sources.writers import TransformSpec, materialize_layer


def test_functions_of_the_dialect(spark, rows):
    table = rows("s string, n int", ("  a $1 ", 1), (None, None), ("2026-02-30", 3), ("2026-02-03", 4))
    found = run_query(
        spark,
        r"""SELECT trimBoth(s) AS a, trimLeft(s) AS b, trimRight(s) AS c, toString(n) AS d, replaceRegexpAll(s, '([a-z]) (.)', '\\2-\\1$') AS e,
        replaceAll(s, '-', '/') AS f, match(s, '^2026') AS g, notEmpty(s) AS h, toDateOrNull(s) AS i, toInt64OrNull(s) AS j, upperUTF8(s) AS k FROM db.t""",
        {"db.t": table},
    ).collect()
    assert tuple(found[0])[:8] == ("a $1", "a $1 ", "  a $1", "1", "  $-a$1 ", "  a $1 ", False, True) and found[0]["k"] == "  A $1 "
    assert all(v is None for v in found[1])
    assert found[2]["i"] is None and str(found[3]["i"]) == "2026-02-03" and found[3]["f"] == "2026/02/03"


def test_table_names_in_quotes_comments_and_columns(spark, rows):
    text = """/* db.t */ SELECT db.t.k, 'db.t; it''s' AS quoted, x.v -- db.t
    FROM db.t JOIN db.t2 AS x ON db.t.k = x.k;"""
    found = run_query(spark, text, {"db.t": rows("k int", (1,)), "db.t2": rows("k int, v string", (1, "a"))}).collect()
    assert [tuple(r) for r in found] == [(1, "db.t; it's", "a")]


def test_unknown_names_stop_with_their_name(spark, rows):
    with pytest.raises(QueryBroken, match="surprise"):
        run_query(spark, "SELECT surprise(k) FROM db.t", {"db.t": rows("k int", (1,))})
    with pytest.raises(QueryBroken, match="db.other"):
        run_query(spark, "SELECT k FROM db.other", {"db.t": rows("k int", (1,))})


@pytest.mark.parametrize("text", ["DROP TABLE x", "SELECT 1; DROP TABLE x", "", "INSERT INTO db.t SELECT 1"])
def test_commands_are_refused(spark, text):
    with pytest.raises(QueryBroken, match="one query"):
        run_query(spark, text, {})


def test_inputs_leave_no_views(spark, rows):
    run_query(spark, "SELECT * FROM db.t", {"db.t": rows("k int", (1,))})
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("step_input")]


def test_bodies_are_inlined(spark, rows):
    found = run_query(spark, "SELECT trimBoth(k) AS k FROM db.t WHERE match(k, 'a')", {"db.t": rows("k string", ("a",))})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(" in plan and all(name.lower() not in plan.lower() for name in ("trimBoth", "SQLFunction"))


def test_specs_with_queries():
    step = "source: {table: a}\ntarget: {table: b}\ntransformation: {query_file: q.sql}\n"
    with pytest.raises(SpecBroken, match="q.sql"):
        load_spec(step)
    with pytest.raises(SpecBroken, match="deduplicate"):
        load_spec(step + "processing: {deduplicate: false}", query="SELECT 1")
    assert load_spec(step + "processing: {deduplicate: true}", query="SELECT 1").target == "b"


@pytest.fixture
def step(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def put(*values):
        spark.createDataFrame([(v,) for v in values], "v int").write.mode("overwrite").parquet(source)

    held = lambda: sorted(r["v"] for r in spark.read.schema("v int").parquet(target).collect())
    return TransformSpec("copy", {"s": source}, target, lambda s: s), put, held


def test_a_write_that_dies_leaves_the_old_target(spark, step):
    spec, put, held = step
    put(1, 2)
    materialize_layer(spark, spec)
    put(3)
    broken = TransformSpec("copy", spec.sources, spec.target, lambda s: s.selectExpr("cast(raise_error('dies') as int) as v"))
    with pytest.raises(Exception, match="dies"):
        materialize_layer(spark, broken)
    assert held() == [1, 2]
    materialize_layer(spark, spec)
    assert held() == [3]


def test_a_run_that_dies_between_the_renames_is_recovered(spark, step):
    spec, put, held = step
    put(1)
    materialize_layer(spark, spec)
    files, path = writers.files_of(spark, spec.target)
    files.rename(path(spec.target), path(writers._old(spec.target)))
    writers.recover(spark, spec.target)
    assert held() == [1]
    files.rename(path(spec.target), path(writers._old(spec.target)))
    put(2)
    materialize_layer(spark, spec)
    assert held() == [2] and not files.exists(path(writers._old(spec.target)))


def test_catalog_tables_are_replaced(spark, step):
    spec, put, _ = step
    table = TransformSpec("copy", spec.sources, "replaced_table", lambda s: s)
    for values in ((1,), (2, 3)):
        put(*values)
        materialize_layer(spark, table)
        assert sorted(r["v"] for r in spark.table("replaced_table").collect()) == list(values)
    assert not spark.catalog.tableExists("replaced_table__old")


def test_every_function_is_defined(spark):
    sql_steps.define_functions(spark)
    assert all(spark.catalog.functionExists(name) for name in sql_steps.FUNCTIONS)
