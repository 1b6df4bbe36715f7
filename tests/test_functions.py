"""Column functions against plain Python."""

from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tierloom import functions as fn
from tierloom.functions.strings import WHITESPACE

TEXTS = [
    "", " ", "  a b ", "\t\n x \r", "　wide ", "mary-jane  o'neil", "ÉCOLE été", "a b\tc", "NaN", "ß", "x", "ALL CAPS  here",
    "\x1cseparator\x1f", "tab\tin\nside",
]


def values(rows, column, texts=TEXTS, schema="s string"):
    df = rows(schema, *[(t,) for t in texts])
    return [r[0] for r in df.select(column).collect()]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_ws(rows):
    assert values(rows, fn.strip_ws(F.col("s"))) == [t.strip() for t in TEXTS]


def test_strip_ws_looks_at_whole_characters(rows):
    texts = ["x\u2009", "x\x85", "x\xa0", "xé", "é x", "x😀", "x😀\u3000", "\u1680x", "~", "!", "x\x7f", "x\x1c", None]
    assert values(rows, fn.strip_ws(F.col("s")), texts) == [t and t.strip() for t in texts]


def test_initcap_words(rows):
    assert values(rows, fn.initcap_words(F.col("s"))) == [" ".join(w.capitalize() for w in t.split()) for t in TEXTS]


def test_is_missing_string(rows):
    texts = TEXTS + [None, " none", "<NA>", "Nan ", "nane"]
    expected = [t is None or t.strip().lower() in ("", "<na>", "nan", "none") for t in texts]
    assert values(rows, fn.is_missing_string(F.col("s")), texts) == expected


@pytest.mark.parametrize(
    "name, snake",
    [("UserId", "user_id"), ("user-id", "user_id"), (" User Name ", "user_name"), ("HTTPServer", "http_server"),
     ("already_snake", "already_snake"), ("A", "a"), ("__x__y", "x_y"), ("ID", "id"), ("createdAT", "created_at")],
)
def test_snake_case(name, snake):
    assert fn.snake_case(name) == snake


def test_tags_and_digits(rows):
    texts = ["⟦P:a1⟧Nurse", "⟦p:x⟧ ⟦P:y⟧Cook", "⟦PH:7⟧ +1 (555) 012", None]
    assert values(rows, fn.strip_pii_tags(F.col("s")), texts) == ["Nurse", " Cook", "⟦PH:7⟧ +1 (555) 012", None]
    assert values(rows, fn.digits_only(fn.strip_phone_tags(F.col("s"))), texts) == ["1", "", "1555012", None]


def test_to_number_takes_only_numbers(rows):
    texts = ["12", " 7.5 ", "1e3", "-.5", "10 days", "10d", "0x1p3", "", None, "1,000"]
    assert values(rows, fn.to_number(F.col("s")), texts) == [12.0, 7.5, 1000.0, -0.5, None, None, None, None, None, None]
    assert values(rows, fn.leading_number(F.col("s")), texts)[4:6] == [10.0, 10.0]


def test_parse_bool(rows):
    texts = ["TRUE", " yes", "1", "y", "False", "no", "0", "N", "maybe", None]
    assert values(rows, fn.parse_bool(F.col("s")), texts) == [True] * 4 + [False] * 6
    assert values(rows, fn.parse_bool(F.col("s"), default=True), texts) == [True] * 4 + [False] * 4 + [True] * 2


def test_dates_that_do_not_parse_are_null(rows):
    texts = ["2020-01-05", "2020-01-05 10:00:00", "unknown", "2020-13-01", None]
    assert values(rows, fn.try_date(F.col("s")), texts) == [date(2020, 1, 5), date(2020, 1, 5), None, None, None]


def test_offset_to_utc(rows):
    texts = ["2025-11-04T01:12:03+07:00", "2025-11-04 01:12:03+0700", "soon"]
    utc = values(rows, F.date_format(fn.offset_to_utc(F.col("s")), "yyyy-MM-dd HH:mm:ss"), texts)
    assert utc == ["2025-11-03 18:12:03", "2025-11-03 18:12:03", None]


def test_json_list_and_pseudonym(rows):
    assert values(rows, fn.parse_json_list(F.col("s")), ['["a","b"]', "no json", None]) == [["a", "b"], None, None]
    first, second, third = values(rows, fn.pseudonymize(F.col("s"), "salt"), ["A@x.org", "a@X.org", "b@x.org"])
    assert first == second != third


ZONES = ["Asia/Jakarta", "asia/makassar", "America/New_York", "Europe/Berlin", "ROC", "Mars/Base", "", None, "Factory"]
MOMENTS = [datetime(2024, 3, 10, 6, 59), datetime(2024, 11, 3, 5, 30), datetime(2024, 11, 3, 6, 30), datetime(1970, 1, 1)]


def wall_clock(moment, zone):
    names = {"asia/makassar": "Asia/Makassar", "ROC": "Asia/Taipei"}
    if zone in ("Mars/Base", "", None, "Factory"):
        return moment
    return moment.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(names.get(zone, zone))).replace(tzinfo=None)


def test_local_time_in_every_kind_of_zone(rows):
    pairs = [(m, z) for m in MOMENTS for z in ZONES]
    df = rows("t timestamp_ntz, zone string", *pairs).withColumn("t", F.col("t").cast("timestamp"))
    df = df.withColumn("was", F.col("t").cast("timestamp_ntz"))
    out = fn.convert_utc_to_local(df, ["t"], "zone").select(F.col("t").cast("timestamp_ntz"), "zone", "was").collect()
    assert len(out) == len(pairs)
    assert all(r["t"] == wall_clock(r["was"], r["zone"]) for r in out)


def test_every_listed_zone_is_known_to_the_jvm(spark):
    shifted = fn.zone_table(spark).select(F.from_utc_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"), F.col("zone_id")))
    assert shifted.collect()


def test_no_zone_column_leaves_the_table(rows):
    df = rows("t timestamp", (datetime(2024, 1, 1),))
    assert fn.convert_utc_to_local(df, ["t"], "zone") is df
