import pytest
from pyspark.sql import functions as F

from tierloom.operators import cleaning as C


def test_clean_table_fills_by_type(rows):
    df = rows(
        "`User Id` string, createdAt string, amount string, isOpen boolean, n int",
        (" u1 ", "2024-01-01T00:00:00Z", "12.5", None, 3),
        ("u2", "bad", "10 days", True, None),
        (" nan", "2024-01-02", "1", True, 1),
        ("None", None, "1", False, 1),
    )
    out = C.clean_table(df, keys=["user_id"], numeric=["amount"], datetimes=["created_at"])
    got = out.select("user_id", F.date_format("created_at", "yyyy-MM-dd").alias("d"), "amount", "is_open", "n").collect()
    assert [tuple(r) for r in got] == [("u1", "2024-01-01", 12.5, False, 3), ("u2", "1970-01-01", 0.0, True, 0)]
    assert not any(f.nullable for f in out.schema.fields)


def test_dates_are_found_by_name_and_share(rows):
    days = [f"2024-01-{i + 1:02d}" for i in range(10)]
    values = [(d, "x", d if i < 8 else "no", "no" if i < 3 else d, i) for i, d in enumerate(days)]
    df = rows("updated_at string, timezone string, expired string, start_date string, plain int", *values)
    assert C.infer_datetime_columns(df) == ["updated_at", "expired"]


def test_numbers_in_date_columns_count_nanoseconds(rows):
    df = C.cast_datetimes(rows("update_time bigint", (1_000_000_000,)), ["update_time"])
    assert df.select(F.unix_timestamp("update_time")).first()[0] == 1


def test_all_null_column_is_no_date(rows):
    df = rows("created string", (None,), (None,))
    assert C.infer_datetime_columns(df) == []


def test_assert_no_nulls(rows):
    df = rows("a int, b string", (1, None), (None, None))
    with pytest.raises(C.NullsFound, match="found 3"):
        C.assert_no_nulls(df, "t")
    assert C.assert_no_nulls(C.fill_nulls_by_type(df)) is not None


def test_require_not_null_fails_the_job(rows):
    df = C.require_not_null(rows("a int", (1,), (None,)), ["a"])
    with pytest.raises(Exception, match="null in a"):
        df.collect()
