"""Groups of equal texts against plain Python, also where digests collide and the stream runs in steps."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tierloom.llm import exact_dedup

DATA = [(None, None), (1, ""), (2, " \t\n"), (2, " "), (9, "a  b\tc"), (3, "a b c"), (3, "a\nb c"), (None, "a b c"), (4, " a b c"), (None, "only"), (None, "only"), (5, "x" * 200_000), (6, "x" * 200_000), (7, "x" * 199_999 + "y")]


def wanted():
    groups = {}
    for key, text in DATA:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(key)
    return groups, sorted((str(k), str(min((i for i in ids if i is not None), default=None)), len(ids)) for ids in groups.values() for k in ids)


@pytest.mark.parametrize("options", [{}, {"files_per_batch": 1}, {"digest": lambda text: F.substring(text, 1, 1)}, {"digest": lambda text: F.lit("same")}])
def test_groups(rows, options):
    docs = rows("doc_id long, text string, size int, at string", *[(*d, 1, "x") for d in DATA])
    found = exact_dedup.exact_duplicates(docs, **options).collect()
    groups, expected = wanted()
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == len(groups)
    if not options:
        assert {r["digest"] for r in found} == {hashlib.sha256(t.encode()).hexdigest() for t in groups}


def test_rows_that_stay_keep_their_columns(rows):
    docs = rows("doc_id long, text string, kept int", *[(*d, 1) for d in DATA])
    stays = exact_dedup.drop_exact_duplicates(docs)
    assert stays.columns == docs.columns and stays.count() == len(wanted()[0])


def test_empty_table(rows):
    docs = rows("doc_id long, text string", (1, "a")).limit(0)
    assert exact_dedup.exact_duplicates(docs).collect() == []


def test_state_outlives_a_run(spark, rows, monkeypatch, tmp_path):
    """A second run over the same state folder sees the digests of the first."""
    base = str(tmp_path / "state")
    monkeypatch.setattr(exact_dedup, "scratch_dir", lambda _: base)
    arrivals, schema = f"{base}/arrivals", "at bigint, id bigint, digest string"
    rows(schema, (0, 5, "d"), (1, 6, "e")).write.parquet(arrivals)
    exact_dedup.remember(spark, arrivals, schema, files_per_batch=100)
    rows(schema, (2, 4, "d"), (3, 9, "d")).write.mode("append").parquet(arrivals)
    found = {r["digest"]: (r["first"]["id"], r["size"]) for r in exact_dedup.remember(spark, arrivals, schema, files_per_batch=100).collect()}
    assert found == {"d": (4, 3), "e": (6, 1)}
