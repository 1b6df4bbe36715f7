"""Targets, tilts and rounding."""

import math
import random
import re

from tierloom.llm import mixing
from tierloom.llm.shared import read


def test_targets_fill_up():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == {"a": 187.5, "b": 75.0, None: 37.5}
    capped = mixing.targets({"a": 10, "b": 400, "c": 400})
    assert capped["a"] == 30 and math.isclose(capped["b"], 780 * 2 / 3) and math.isclose(sum(capped.values()), 810)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0, "b": 5}) == {"a": 0.0, "b": 5.0}
    assert list(mixing.targets({"b": 1, "É": 1, "Z": 1, None: 1})) == ["Z", "b", "É", None]


def test_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    found = mixing.mix(docs).collect()
    assert {r["id"]: r["size"] for r in found} == sizes
    by_source = {}
    for r in found:
        assert 0 <= r["copies"] <= 3 and 0 <= r["rate"] <= 3
        by_source.setdefault(r["source"], []).append(r)
    goal = mixing.targets({s: sum(r["size"] for r in held) for s, held in by_source.items()})
    for source, held in by_source.items():
        assert math.isclose(held[0]["target"], goal[source])
        least = min(r["size"] for r in held if r["size"])
        assert abs(sum(r["copies"] * r["size"] for r in held) - goal[source]) <= max(least, 0.01 * goal[source])
        assert abs(sum(r["rate"] * r["size"] for r in held) - goal[source]) <= 1e-6 * goal[source]
    assert sorted(found, key=str) == sorted(mixing.mix(docs).collect(), key=str)


def test_rates_are_exponential_tilts(rows):
    rng = random.Random(2)
    docs = rows("doc_id long, text string, source string", *[(i, "w " * rng.randrange(1, 60), rng.choice("ab")) for i in range(400)])
    slopes = {}
    for r in mixing.mix(docs).collect():
        odds = math.log(2 * r["rate"] / (3 - r["rate"])) / r["size"]
        slopes.setdefault(r["source"], []).append(odds)
    assert all(max(s) - min(s) < 1e-9 for s in slopes.values()) and slopes["a"][0] > 0 > slopes["b"][0]


def test_defined_results(rows):
    docs = rows(
        "doc_id long, text string, source string, copies string, at int",
        (None, None, None, "x", 1), (1, "", "a", "x", 1), (2, "one two", "a", "x", 1), (2, "one two", "a", "x", 1), (3, "w " * 50_000, "b", "x", 1), (4, "a b c", None, "x", 1),
    )
    found = mixing.mix(docs).collect()
    assert {(r["id"], r["size"]) for r in found} == {(None, 0), (1, 0), (2, 2), (3, 50_000), (4, 3)} and len(found) == 6
    assert all(r["copies"] == 0 for r in found if r["size"] == 0)
    assert all(r["copies"] == 3 for r in found if r["source"] in ("a", None) and r["size"])
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in found)
    assert mixing.mix(docs.limit(0)).collect() == []
