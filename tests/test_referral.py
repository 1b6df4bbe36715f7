"""Referral report on hand-written rows, one test per rule of thumb that is easy to get wrong."""

from datetime import datetime

import pytest
from tierloom.plans import referral as R

FILES = {
    "lead_logs": """id,lead_id,source_category,created_at,preferred_location,timezone_location,current_status
1,guest3,Online,2024-05-01T01:30:15.250Z,NORTH SIDE,Asia/Jakarta,Fresh
2,guest3,Offline,2024-05-01T01:30:15.250Z,SOUTH,Asia/Jakarta,Warm
""",
    "paid_transactions": """transaction_id,transaction_status,transaction_at,transaction_location,timezone_transaction,transaction_type
t1,PAID,2024-05-02T03:20:30.125Z,NORTH  SIDE,Asia/Jakarta,NEW
t2,pending,2024-05-31T20:00:00Z,SOUTH,Asia/Makassar,REJOIN
t9,PAID,2024-05-02T03:20:30Z,NORTH,null,NEW
""",
    "referral_rewards": """id,reward_value,created_at,reward_type
1,10 days,2024-01-02T03:04:05Z,1
2,20,2024-01-02T03:04:06Z,1
""",
    "user_logs": """id,user_id,name,phone_number,homeclub,timezone_homeclub,membership_expired_date,is_deleted
1,host1,ann  lee,p1,EAST CLUB,Asia/Jakarta,2024-06-02,false
2,host1,ann lee,p1,EAST CLUB,Asia/Makassar,2024-01-01,true
3,host2,bob,p2,WEST,Mars/Base,2030-01-01,false
""",
    "user_referral_logs": """id,user_referral_id,source_transaction_id,created_at,is_reward_granted
1,r1,null,2024-05-03T00:00:00Z,TRUE
2,r1,null,2024-05-02T00:00:00Z,FALSE
3,gone,null,2024-05-02T00:00:00Z,FALSE
""",
    "user_referral_statuses": """id,description,created_at
1,Menunggu,2024-01-03T04:05:06Z
2,Berhasil,2024-01-03T04:05:07Z
""",
    "user_referrals": """referral_at,referral_id,referee_id,referee_name,referee_phone,referral_reward_id,referral_source,referrer_id,transaction_id,updated_at,user_referral_status_id
2024-05-01T20:00:00Z,r1,guest1,guest ONE,f1,2,Draft Transaction,host1,t1,2024-05-01T20:00:00Z,2
2024-05-31T23:00:00Z,r2,guest2,null,f2,1,User Sign Up,null,t2,2024-05-31T23:00:00Z,1
2024-04-01T00:00:00Z,r3,guest3,nan,f3,null,Lead,nobody,null,2024-04-01T00:00:00Z,1
2024-04-02T00:00:00Z,r4,host1,x,f4,null,Lead,null,null,null,1
2024-04-02T00:00:00Z,r5,guest5,x,f5,2,Lead,host2,t9,2024-04-02T00:00:00Z,7
2024-05-01T20:00:00Z,r1,guest1,guest ONE,f1,2,Draft Transaction,host1,t1,2024-05-01T20:00:00Z,2
""",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("referrals")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    return R.read_tables(spark, str(folder))


@pytest.fixture(scope="module")
def report(tables):
    return {r["referral_id"]: r for r in R.referral_report(tables, expected_rows=5).collect()}


def test_columns_are_in_order(tables):
    assert tuple(R.referral_report(tables).columns) == R.REPORT_COLUMNS


def test_valid_referral(report):
    row = report["r1"]
    assert row["is_business_logic_valid"] is True
    assert row["reward_value"] == 20.0 and row["referral_reward_id"] == 2.0
    assert row["is_reward_granted"] == "True", "the newest log wins"
    assert (row["transaction_status"], row["transaction_type"]) == ("Paid", "New")
    assert row["transaction_location"] == "North Side" and row["name_referrer"] == "Ann Lee"
    assert row["homeclub_referrer"] == "EAST CLUB" and row["referee_name"] == "Guest One"


def test_user_record_and_user_zone_come_from_different_rows(report):
    row = report["r1"]
    # The record with the latest membership end is row 1 (Jakarta), the zone lookup ends with row 2 (Makassar).
    assert row["membership_expired_date_referrer"] == datetime(2024, 6, 2, 7)
    assert row["is_deleted_referrer"] == "False"
    assert row["referral_at"] == datetime(2024, 5, 2, 4)
    assert row["transaction_at"] == datetime(2024, 5, 2, 10, 20, 30, 125000)


def test_words_for_missing_values(report):
    row = report["r2"]
    assert row["referral_at"] == datetime(2024, 5, 31, 23), "no zone known, UTC stays"
    assert row["transaction_at"] == datetime(2024, 6, 1, 4)
    assert row["homeclub_referrer"] == "UNKNOWN" and row["name_referrer"] == "Unknown"
    assert row["is_reward_granted"] == "Unknown" and row["is_deleted_referrer"] == "Unknown"
    assert row["membership_expired_date_referrer"] == datetime(1970, 1, 1)
    assert row["reward_value"] == 0.0, "10 days is no number"
    assert row["referee_name"] == "Unknown" and row["referrer_id"] == "Unknown"


def test_lead_category_and_tie(report):
    row = report["r3"]
    assert (row["referral_source_category"], row["current_status"]) == ("Online", "Fresh")
    assert row["preferred_location"] == "North Side"
    assert report["r1"]["referral_source_category"] == "Offline"
    assert report["r2"]["referral_source_category"] == "Online"
    assert report["r5"]["referral_source_category"] == "Unknown"


def test_zone_falls_back_to_the_referee(report):
    row = report["r4"]
    # Referrer blank, referee is host1, whose lookup zone is Makassar.
    assert row["referral_at"] == datetime(2024, 4, 2, 8)
    assert row["homeclub_referee"] == "EAST CLUB" and row["is_deleted_referee"] == "False"


def test_null_timestamp_is_the_epoch_before_the_shift(tables):
    moved = R.apply_timezones(R.clean_tables(tables))["user_referrals"]
    assert moved.where("referral_id = 'r4'").first()["updated_at"] == datetime(1970, 1, 1, 8)


def test_unknown_zone_and_null_zone_stay_in_utc(report):
    assert report["r5"]["referral_at"] == datetime(2024, 4, 2)
    assert report["r5"]["transaction_at"] == datetime(2024, 5, 2, 3, 20, 30)
    assert report["r5"]["description"] == "Unknown"


def test_leading_number_reward(tables):
    report = R.referral_report(tables, reward_parse="leading_number")
    assert report.where("referral_id = 'r2'").first()["reward_value"] == 10.0


def test_log_order_by_instant_gives_the_same_rows(tables):
    a, b = R.referral_report(tables), R.referral_report(tables, log_order="instant")
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_short_path_equals_step_by_step(tables):
    cleaned = R.clean_tables(tables)
    steps, short = R.build_final_dataset(R.apply_timezones(cleaned)), R.joined_report(cleaned)
    assert set(steps.columns) == set(short.columns)
    assert sorted(map(str, steps.collect())) == sorted(map(str, short.select(steps.columns).collect()))


def test_heavy_keys_change_no_row(tables):
    plain = R.referral_report(tables)
    spread = R.referral_report(tables, rows_per_task=1)
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))


def test_wrong_row_count_stops(tables):
    with pytest.raises(ValueError, match="expected 46 rows, got 5"):
        R.referral_report(tables, expected_rows=46)


def test_missing_report_columns_are_named(rows):
    with pytest.raises(ValueError, match="referral_at"):
        R.select_report_columns(rows("referral_id string", ("r",)))


def test_rules_without_their_column_do_not_hold(rows):
    df = R.business_rules(rows("referral_id string, is_deleted_referrer string, description string", ("r", None, " BERHASIL ")))
    row = df.first()
    assert row["rule_referrer_not_deleted"] is True, "unknown counts as not deleted"
    assert row["rule_status_success"] is True
    assert row["rule_reward_positive"] is False and row["is_business_logic_valid"] is False


def test_reward_may_be_a_number_or_text(rows):
    numbers, texts = [3.0, 0.0, -1.0, None, float("nan"), float("inf")], ["3", "0", "-1", None, "nan", "inf"]
    for schema, given in (("reward_value double", numbers), ("reward_value string", texts)):
        df = R.business_rules(rows(schema, *[(v,) for v in given]))
        assert [r[0] for r in df.select("rule_reward_positive").collect()] == [True, False, False, False, False, True]


def test_missing_words_in_any_case(rows):
    texts = ["NONE", "<Na>", "NaN", "", None, "nones", "Nane", "ſnan", "İnan", "none x"]
    shown = [r[0] for r in R.format_strings(rows("title string", *[(t,) for t in texts])).collect()]
    assert shown[:5] == ["Unknown"] * 5 and "Unknown" not in shown[5:]


def test_membership_rule_has_no_fallback_per_row(rows):
    schema = "membership_expired_date_referrer timestamp, transaction_at timestamp, referral_at timestamp"
    late, early = datetime(2024, 2, 1), datetime(2024, 1, 1)
    df = rows(schema, (late, None, early), (late, early, early), (early, early, None))
    assert [r[0] for r in R.business_rules(df).select("rule_membership_active").collect()] == [False, True, False]
    no_transactions = R.business_rules(df.drop("transaction_at"))
    assert [r[0] for r in no_transactions.select("rule_membership_active").collect()] == [True, True, False]


def test_report_row_and_preview(tables):
    report = R.referral_report(tables)
    assert R.report_row(report, "r3").count() == 1
    assert [r["referral_id"] for r in R.preview(report, 2).collect()] == ["r1", "r2"]


def test_cardinality_check(tables):
    got = R.join_cardinality_check(R.apply_timezones(R.clean_tables(tables))).collect()
    assert [(r["rows_before"], r["rows_after"]) for r in got] == [(5, 5)] * 7


def test_duplicate_id_count(tables):
    df = R.clean_tables(tables)["user_referrals"]
    assert R.duplicate_id_count(df).first()[0] == 1


def test_duplicate_id_count_with_nulls(rows):
    df = rows("referral_id string", (None,), (None,), ("a",), ("a",))
    assert R.duplicate_id_count(df).first()[0] == 2


def test_enums(rows):
    df = R.normalize_enums(rows("transaction_status string", ("PAID",), (" paid",), ("on hold",), (None,), ("nan",)))
    assert [r[0] for r in df.collect()] == ["Paid", "Paid", "On Hold", "", ""]


def test_format_leaves_ids_zones_and_phones(rows):
    schema = "user_id string, timezone_x string, phone string, homeclub string, title string"
    got = R.format_strings(rows(schema, ("aB", "Asia/x", "pQ", " ", "hello  WORLD"), (None, None, None, "b CLUB", " none "))).collect()
    assert tuple(got[0]) == ("aB", "Asia/x", "pQ", "UNKNOWN", "Hello World")
    assert tuple(got[1]) == (None, None, None, "b CLUB", "Unknown")


def test_rules_can_compare_in_utc(tables):
    """r2 is referred on 31 May 23:00 UTC and paid three hours earlier, in a zone eight hours ahead: on local clocks
    the payment is on 1 June and later, in UTC it is earlier and in the same month."""
    cleaned = R.clean_tables(tables)
    wide = R.joined_report(cleaned, keep_utc=True)
    rules = ["rule_transaction_after_referral", "rule_same_month"]
    local, utc = (R.business_rules(wide, flag).where("referral_id = 'r2'").select(rules).first() for flag in (False, True))
    assert tuple(local) == (True, False) and tuple(utc) == (False, True)


@pytest.mark.parametrize("referral_id", [{}, {"r1": 9}])
def test_wide_rows_are_not_shuffled_by_all_columns(tables, capsys, referral_id):
    """Only a heavy referral id can have many copies of a row, which are then merged before they are joined."""
    cleaned, heavy = R.clean_tables(tables), dict.fromkeys((*R.JOIN_KEYS, "user_referral_id", R.PAID_ID), {})
    heavy |= {"referral_id": referral_id, "referrer_id": {"": 9}, "referee_id": {"": 9}}
    wide = R.build_final_dataset(R.apply_timezones(cleaned, heavy), heavy)
    short = R.joined_report(cleaned, heavy)
    for df in (wide, short):
        df.explain()
        shuffles = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in line]
        merged = [line for line in shuffles if "referee_phone" in line.partition("ENSURE")[0]]
        assert shuffles and bool(merged) == bool(referral_id)
    plain = R.build_final_dataset(R.apply_timezones(cleaned))
    assert sorted(map(str, wide.collect())) == sorted(map(str, plain.collect()))
    assert sorted(map(str, short.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("heavy", [None, {"transaction_id": {"t1": 9}, R.PAID_ID: {"t1": 9}}])
def test_rows_multiplied_by_transactions_are_not_shuffled(spark, tables, capsys, heavy):
    cleaned = R.clean_tables(tables)
    for build in (R.build_final_dataset, R.joined_report):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            build(cleaned, heavy).explain()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        lines = capsys.readouterr().out.splitlines()
        depths = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        (at,) = [i for i, line in enumerate(lines) if "Join" in line and "_paid_id" in line and "_heavy" not in line]
        above = [line for i, line in enumerate(lines[:at]) if depths[i] < min(depths[i + 1 : at + 1])]
        assert len(above) > 1 and not any("Exchange" in line for line in above)


@pytest.mark.parametrize("rows_per_task", [R.ROWS_PER_TASK, 1])
def test_large_reports_are_made_in_two_steps(tables, monkeypatch, rows_per_task):
    cleaned, heavy = R.clean_tables(tables), R.find_heavy(tables, rows_per_task)
    assert heavy[R.ROWS] == {"user_referrals": 6, "user_referral_logs": 3, "paid_transactions": 3}

    def made():
        wide = R.build_final_dataset(R.apply_timezones(cleaned, heavy), heavy)
        report = R.referral_report(tables, rows_per_task=rows_per_task, compare_in_utc=True)
        return [(df.columns, sorted(map(str, df.collect()))) for df in (wide, report)]

    steps, plain = [], made()
    monkeypatch.setattr(R, "STAGED_ROWS", 0)
    monkeypatch.setattr(R, "stored", lambda df, store=R.stored: steps.append(df.columns) or store(df))
    assert made() == plain
    assert len(steps) == 2 and set(steps[1]) <= set(R.STEP_COLUMNS)
