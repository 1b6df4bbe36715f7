"""Silver and gold on hand-written rows."""

from datetime import date

import pytest

from tierloom.operators import quality as Q
from tierloom.plans import gold, silver

EMPLOYMENT = (
    "contact_id string, employer_name string, title string, occupation string, start_date date, end_date string, "
    "is_current boolean, organization_id string, processing_date date, row_id int"
)
START, DAY1, DAY2 = date(2020, 1, 1), date(2026, 3, 1), date(2026, 3, 2)


@pytest.fixture
def employments(rows):
    return rows(
        EMPLOYMENT,
        (" c1 ", "  ", None, "⟦P:7⟧ Nurse ", START, "2021-01-01", None, " org1", DAY2, 1),
        ("c1", "ACME", "boss", "nurse", START, "unknown", True, "org1 ", DAY1, 2),
        ("c2", "X", "t", "cook", START, None, True, "org_pii_masking", DAY2, 3),
        ("c2", "X", "t", "cook", START, None, True, "org1", DAY1, 4),
        ("c3", "⟦P:1⟧X", "t", "⟦p:2⟧ ", START, None, True, "org1", DAY1, 5),
        ("c4", "X", "t", "cook", None, None, False, "org1", DAY1, 6),
        ("c5", "X", "t", "cook", START, None, True, None, DAY1, 7),
        ("c6", "⟦P:1⟧X", "t", "cook", START, None, True, "org2", DAY1, 8),
    )


@pytest.fixture
def phones(rows):
    return rows(
        "contact_id string, label string, number string, organization_id string, processing_date date, row_id int",
        ("c1", " MOBILE", "⟦PH:9⟧+1 (555) 0001", "org1", DAY1, 1),
        ("c1", "office", "15550001", "org1", DAY2, 2),
        ("c4", None, "12 34 56", "org1", DAY1, 3),
        ("c6", "Home", "1234567", "org_pii_masking", DAY1, 4),
        (None, "Home", "1234567", "org1", DAY1, 5),
    )


def test_silver_employments(employments):
    out = {r["contact_id"]: r for r in silver.silver_contact_employments(employments, tie_break=["row_id"]).collect()}
    assert set(out) == {"c1", "c4", "c6"}
    assert out["c1"]["is_current"] is True and out["c1"]["employer_name"] == "ACME", "a current job beats a newer row"
    assert out["c1"]["end_date"] is None and out["c1"]["occupation"] == "nurse"
    assert out["c6"]["employer_name"] == "⟦P:1⟧X", "tags are removed from the occupation only"


def test_masked_winner_takes_its_twin_along(employments):
    contacts = [r[0] for r in silver.silver_contact_employments(employments).select("contact_id").collect()]
    assert "c2" not in contacts and "c5" not in contacts


def test_tags_in_other_columns_on_request(employments):
    cleaned = silver.clean_employments(employments, tagged=("occupation", "employer_name"))
    assert cleaned.where("contact_id = 'c6'").first()["employer_name"] == "X"


def test_other_organization_column(employments):
    renamed = employments.withColumnRenamed("organization_id", "tenant")
    out = silver.silver_contact_employments(renamed, org="tenant")
    assert "tenant" in out.columns and gold.contacts_by_org(out, "tenant").columns == ["tenant", "contact_count"]


def test_silver_phones(phones):
    out = silver.silver_contact_phones(phones, tie_break=["row_id"]).collect()
    assert sorted((r["contact_id"], r["label"], r["number"]) for r in out) == [("c1", "office", "15550001"), ("c6", "home", "1234567")]
    kept = silver.silver_contact_phones(phones, remove_masked=True).collect()
    assert [r["contact_id"] for r in kept] == ["c1"]


def test_gold(employments, phones):
    e, p = silver.silver_contact_employments(employments), silver.silver_contact_phones(phones)
    assert {tuple(r) for r in gold.contacts_by_org(e).collect()} == {("org1", 2), ("org2", 1)}
    assert [tuple(r) for r in gold.contacts_by_occupation(e).collect()] == [("cook", 2), ("nurse", 1)]
    assert [tuple(r) for r in gold.current_employments(e).collect()] == [("org1", 1), ("org2", 1)]
    assert [tuple(r) for r in gold.contacts_without_phone(e, p).collect()] == [("org1", 1)]
    assert [tuple(r) for r in gold.phone_type_distribution(p).collect()] == [("home", 1), ("office", 1)]
    assert gold.total_current_employed(e).first()[0] == 2
    coverage = {r["organization_id"]: r["phone_coverage_pct"] for r in gold.phone_coverage_pct(e, p).collect()}
    assert coverage == {"org1": 50.0, "org_pii_masking": 100.0}


def verdicts(df):
    return {r["check"]: (r["observed"], r["passed"]) for r in df.collect()}


def test_every_employment_check_can_fail(employments):
    broken = silver.clean_employments(employments).replace("cook", "⟦p:cook")
    found = verdicts(Q.run_checks(broken, Q.employment_checks()))
    assert found == {
        "row_count_check": (8, True),
        "contact_id_not_null": (0, True),
        "valid_uuid_contact_id": (8, False),
        "start_date_valid": (1, False),
        "pii_tags_removed": (5, False),
        "remove_pii_masking_rows": (1, False),
        "duplicate_employment_check": (2, False),
    }


def test_every_phone_check_can_fail(phones, rows):
    found = verdicts(Q.run_checks(silver.clean_phones(phones), Q.phone_checks()))
    assert found == {
        "row_count_check": (5, True),
        "contact_id_not_null": (1, False),
        "phone_number_not_null": (0, True),
        "phone_number_length": (1, False),
        "remove_pii_masking_rows": (1, False),
        "duplicate_phone_check": (1, False),
    }
    empty = rows("contact_id string, number string, organization_id string")
    assert verdicts(Q.run_checks(empty, [Q.row_count()])) == {"row_count_check": (0, False)}


def test_freshness(rows):
    df = rows("processing_date date", (DAY1,), (DAY2,))
    assert verdicts(Q.check_freshness(df, "2026-03-05", 3)) == {"freshness": (3, True)}
    assert verdicts(Q.check_freshness(df, "2026-03-06", 3)) == {"freshness": (4, False)}
    assert verdicts(Q.check_freshness(rows("processing_date date"), "2026-03-06", 3)) == {"freshness": (None, None)}


def test_gold_not_null(rows):
    found = Q.check_gold_not_null({"g": rows("label string, n int", (None, 1), ("a", None), (None, 2))}).collect()
    assert [(r["table"], r["check"], r["observed"]) for r in found] == [("g", "label_not_null", 2), ("g", "n_not_null", 1)]


def test_text_checks(rows):
    df = rows("occupation string", ("Cook",), (" ",), (None,), ("cook",))
    found = verdicts(Q.run_checks(df, [*Q.empty_strings(["occupation"]), Q.occupation_lowercase()]))
    assert found == {"occupation_not_blank": (1, False), "occupation_lowercase": (1, False)}
