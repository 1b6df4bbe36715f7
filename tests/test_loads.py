"""Loads of new files, batches that are repeated, and silver kept day by day."""

import csv
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_storage import THREAD, email

from tierloom.plans import daily, emails as M, silver
from tierloom.streaming import loads


@pytest.fixture
def inbox(tmp_path):
    """Writes a file into a folder, in the order of its name."""
    folder = tmp_path / "inbox"
    folder.mkdir()

    def land(name, *values, header=M.EMAIL_COLUMNS):
        with open(folder / name, "w", newline="") as file:
            out = csv.writer(file)
            out.writerow(header)
            out.writerows(values)
        return str(folder)

    return land


def threads(spark, target):
    return {r["thread_id"]: r["subject"] for r in spark.read.parquet(target).collect()}


def test_second_run_reads_the_new_file_only(spark, inbox, tmp_path):
    target, state = str(tmp_path / "table"), str(tmp_path / "state")
    folder = inbox("1.csv", email(subject="one"), email(subject="again"), email(thread_id=THREAD.format(2), email_status="done"))
    load = lambda: loads.load_emails_table(spark, folder, target, state, multi_line=True)
    assert [b.rows for b in load()] == [3]
    inbox("2.csv", email(subject="late"), email(thread_id=THREAD.format(3), subject="three\nlines"))
    assert [b.rows for b in load()] == [2], "progress counts the new file's rows"
    assert load() == []
    assert threads(spark, target) == {THREAD.format(1): "one", THREAD.format(3): "three\nlines"}


def test_missing_words_and_file_order(spark, inbox, tmp_path):
    folder, seen = inbox("1.csv", *[email(thread_id=THREAD.format(i), subject="NA" if i % 2 else "s") for i in range(50)]), []
    write = lambda rows, number: seen.extend(rows.orderBy(loads.FILE_ORDER).collect())
    loads.load_new_files(spark, folder, M.EMAIL_COLUMNS, write, str(tmp_path / "state"), multi_line=True)
    assert [r["thread_id"] for r in seen] == [THREAD.format(i) for i in range(50)]
    assert [r["subject"] for r in seen] == ["s", None] * 25


@pytest.mark.parametrize("after_writing", [False, True])
def test_a_run_that_dies_is_continued(spark, inbox, tmp_path, monkeypatch, after_writing):
    """Killed in its second batch, before or after that was written, the next run ends with the rows of one run."""
    for i in range(4):
        folder = inbox(f"{i}.csv", *[email(thread_id=THREAD.format(10 * i + j), timestamp=f"2026-0{1 + j}-05 05:00:00+00:00") for j in range(3)], email(timestamp="bad"))
    bucket, state = str(tmp_path / "bucket"), str(tmp_path / "state")
    load = lambda: loads.load_emails_partitioned(spark, folder, bucket, state, multi_line=True, files_per_batch=1)
    publish, calls = loads.publish_to_uri, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            if after_writing:
                publish(*args)
            raise RuntimeError("killed")
        return publish(*args)

    monkeypatch.setattr(loads, "publish_to_uri", dies)
    with pytest.raises(StreamingQueryException, match="killed"):
        load()
    monkeypatch.setattr(loads, "publish_to_uri", publish)
    load()
    found = spark.read.parquet(f"{bucket}/customer_care_emails")
    assert sorted(r["thread_id"] for r in found.collect()) == sorted(THREAD.format(10 * i + j) for i in range(4) for j in range(3))
    assert {(r["month"], r["load"]) for r in found.collect()} == {(m, n) for m in (1, 2, 3) for n in range(4)}


def test_a_new_state_is_refused_for_old_loads(spark, inbox, tmp_path):
    folder, bucket = inbox("1.csv", email()), str(tmp_path / "bucket")
    loads.load_emails_partitioned(spark, folder, bucket, str(tmp_path / "state"), multi_line=True)
    with pytest.raises(ValueError, match="does not know"):
        loads.load_emails_partitioned(spark, folder, bucket, str(tmp_path / "other"), multi_line=True)


def test_a_wrong_header_stops_until_it_is_mended(spark, inbox, tmp_path):
    target, state = str(tmp_path / "table"), str(tmp_path / "state")
    folder = inbox("1.csv", email(), header=("sender", "subject", *M.EMAIL_COLUMNS[2:]))
    load = lambda: loads.load_emails_table(spark, folder, target, state, multi_line=True)
    with pytest.raises(StreamingQueryException):
        load()
    inbox("1.csv", email(subject="mended"))
    load()
    assert threads(spark, target) == {THREAD.format(1): "mended"}


def test_state_lies_in_the_shared_folder(spark):
    assert loads.state_dir(spark, "emails") == f"{spark.conf.get('spark.checkpoint.dir')}/loads/emails"


EMPLOYMENT = "contact_id string, employer_name string, title string, occupation string, start_date date, end_date string, is_current boolean, organization_id string, processing_date date, row_id long"


def job(contact, day, org="org_1", current=True, occupation="cook", row_id=0):
    return (contact, "e", "t", occupation, date(2020, 1, 1), None, current, org, date(2026, 3, day), row_id)


DAYS = {
    1: [job("a", 1), job("b", 1), job("c", 1, current=False), job("d", 1, "org_pii_masking"), job(None, 1)],
    # A masked newcomer beats a, an older state of b loses, c becomes current, d is unmasked.
    2: [job("a", 2, "org_pii_masking"), job("b", 2, current=False), job("c", 2), job("d", 2), job("e", 2, occupation=None)],
    3: [job("f", 3), job("b", 3), job("b", 3, "org_2", row_id=1)],
}


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 1, 2), (1, 2, 2, 3, 1)])
def test_days_one_by_one_give_what_all_days_give(rows, spark, tmp_path, order):
    for day in order:
        found = daily.update_employments(spark, rows(EMPLOYMENT, *DAYS[day]), str(tmp_path / "winners"), tie_break=["row_id"])
    whole = silver.silver_contact_employments(rows(EMPLOYMENT, *[r for d in DAYS.values() for r in d]), tie_break=["row_id"])
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert "a" not in [r["contact_id"] for r in found.collect()], "the masked row took the row it beats with it"


def test_changes_of_a_day(rows, spark, tmp_path):
    found = {}
    for day in DAYS:
        daily.update_employments(spark, rows(EMPLOYMENT, *DAYS[day]), str(tmp_path / "winners"), tie_break=["row_id"], changes_to=str(tmp_path / "changes"))
        found[day] = sorted((r["contact_id"] or "-", r["change"]) for r in spark.read.parquet(str(tmp_path / "changes")).collect())
    assert found == {
        1: [("-", "added"), ("a", "added"), ("b", "added"), ("c", "added")],
        2: [("a", "removed"), ("c", "changed"), ("d", "added")],
        3: [("b", "changed"), ("f", "added")],
    }


def test_a_day_reads_no_earlier_raw_rows(rows, spark, tmp_path):
    path = str(tmp_path / "winners")
    daily.update_phones(spark, rows("contact_id string, label string, number string, organization_id string, processing_date date", ("a", "X", "1234567", "o", date(2026, 3, 1))), path)
    day = rows("contact_id string, label string, number string, organization_id string, processing_date date", ("a", "Y", "123-4567", "o", date(2026, 3, 2)))
    found = daily.update_phones(spark, day, path)
    assert [(r["label"], r["number"]) for r in found.collect()] == [("y", "1234567")]
    assert all(path in f for f in found.inputFiles())


def test_an_empty_day_changes_nothing(rows, spark, tmp_path):
    path = str(tmp_path / "winners")
    daily.update_employments(spark, rows(EMPLOYMENT, *DAYS[1]), path)
    found = daily.update_employments(spark, rows(EMPLOYMENT, *DAYS[1]).where("false"), path)
    assert found.where(F.col("contact_id") == "a").count() == 1 and found.count() == 4
