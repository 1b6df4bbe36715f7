"""Near-duplicates against all pairs, and components against union-find."""

import random
import re

import pytest

from tierloom.llm import near_dedup
from tierloom.llm.components import components
from tierloom.llm.shared import read


def shingle_set(text, words):
    """Shingles by their definition: words of lower-cased text, and every run of so many of them."""
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    runs = {tuple(found[k : k + words]) for k in range(len(found) - words + 1)}
    return runs or ({tuple(found)} if found else set())


def roots(pairs, nodes=()):
    parent = {n: n for n in nodes}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in list(parent)}


def all_pairs(texts, words, percent):
    sets = {i: shingle_set(t or "", words) for i, t in texts.items()}
    keys = [i for i in sets if sets[i]]
    links = [(a, b) for n, a in enumerate(keys) for b in keys[n + 1 :] if 100 * (c := len(sets[a] & sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - c)]
    return roots(links, texts), {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("words", [2, 5])
def test_documents_against_all_pairs(spark, sf_dir, words):
    docs = read(spark, sf_dir, "documents")
    classes, sizes = all_pairs({r["doc_id"]: r["text"] for r in docs.collect()}, words, 80)
    found = near_dedup.near_duplicates(docs, words, 80).collect()
    assert {r["id"]: r["component_id"] for r in found} == classes
    assert {r["id"]: r["n_shingles"] for r in found} == sizes
    assert len([r for r in found if r["first"]]) == len(set(classes.values()))


def test_copies_of_an_original_that_are_not_alike(rows):
    """A star: copies are near the original, not near each other; the original has the largest id."""
    rng = random.Random(4)
    original = [f"w{i}" for i in range(200)]
    texts = {}
    for i in range(120):
        copy = list(original)
        for at in rng.sample(range(200), 9):
            copy[at] = f"x{rng.random()}"
        texts[i] = " ".join(copy)
    texts[500] = " ".join(original)
    texts |= {1000 + i: " ".join(f"r{rng.random()}" for _ in range(50)) for i in range(60)}
    classes, _ = all_pairs(texts, 2, 80)
    found = near_dedup.near_duplicates(rows("doc_id long, text string", *texts.items()), 2, 80).collect()
    assert {r["id"]: r["component_id"] for r in found} == classes


def test_defined_results(rows):
    data = [(None, None), (3, ""), (4, " \n"), (9, "One"), (5, "one"), (5, "ONE "), (None, "one"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "z " * 30_000)]
    docs = rows("doc_id long, text string, digest int, node string", *[(*d, 1, "n") for d in data])
    found = near_dedup.near_duplicates(docs, 2, 80)
    got = sorted(((r["id"], r["n_shingles"], r["component_id"], r["first"]) for r in found.collect()), key=str)
    assert got == sorted(
        [(None, 0, None, True), (3, 0, 3, True), (4, 0, 4, True), (9, 1, 5, False), (5, 1, 5, True), (5, 1, 5, False), (None, 1, 5, False), (7, 5, 7, True), (7, 5, 7, False), (8, 1, 8, True)],
        key=str,
    )
    kept = near_dedup.drop_near_duplicates(docs, 2, 80)
    assert kept.columns == docs.columns and kept.count() == 6
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(rows, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(25 * seed)] + [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(200, 260)]
    wanted = {n: r for n, r in roots([p for p in links if p[0] != p[1]]).items()}
    assert dict(components(rows("a long, b long", *links, (None, 1))).collect()) == wanted


def test_components_of_nothing(rows):
    assert components(rows("a long, b long", (1, 1))).collect() == []
