"""Trees, proofs and tampered leaves against a plain computation, and against SQL."""

import hashlib
import itertools
import zlib

import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from tierloom.llm import merkle
from tierloom.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def steps(tree, place):
    for level in tree[:-1]:
        run = place // 8 * 8
        yield level[run:place], level[place + 1 : run + 8]
        place //= 8


def expected(rows, lower):
    """Sorted result rows of plain Python; equal rows take places of their own."""
    first = lambda v: (v is not None, v if v is not None else 0)
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (first(r[0]), leaf_of(r, r[1])))
    trees = [levels([leaf_of(r, r[1]) for r in by_lang[lang]]) for lang in langs]
    top = levels([t[-1][0] for t in trees])
    out = []
    for number, lang in enumerate(langs):
        for place, row in enumerate(by_lang[lang]):
            path = [*steps(trees[number], place), *steps(top, number)]
            folded = leaf_of(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])) if lower(row) and row[1] else leaf_of(row, row[1])
            for left, right in path:
                folded = digest(*left, folded, *right)
            proof = digest(*itertools.chain.from_iterable(left + right for left, right in path))
            out.append((row[0], leaf_of(row, row[1]), trees[number][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def lower(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0


def found(docs):
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return sorted(map(tuple, merkle.verified(docs, {"text": text}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).collect()), key=str)


@pytest.mark.parametrize(
    "sizes",
    [(1,), (8,), (9, 1), (513, 64, 1), (1,) * 70],
    ids=str,
)
def test_shapes_of_trees(rows, sizes):
    names = [None] + [f"l{i}" for i in range(100)]
    data, number = [], 0
    for lang, size in zip(names, sizes, strict=False):
        for _ in range(size):
            data.append((number, f"Text {number} Ü" * (number % 3), lang, None, number % 5))
            number += 1
    assert found(rows(SCHEMA, *data)) == expected(data, lower)


def test_nulls_repeats_long_texts_and_clashing_names(rows):
    data = [(None, None, None, None, None), (None, "A", "x", "", 0), (7, "", "x", "-", None), (7, "B" * 300_000, "x", "s", 1)]
    data += [(11, "Same", "x", "s", 4)] * 30 + [(-5, "Neg", "ä", "s", 3), (12, "Q", "", None, 1)]
    docs = rows(SCHEMA, *data).withColumns({c: F.lit(1) for c in ("leaf", "tree", "pos", "grp", "start", "copies", "part", "n", "at", "hash", "id")})
    assert found(docs) == expected(data, lower)


def test_many_equal_rows_are_dealt_in_portions(rows, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 7)
    data = [(11, "Same", "x", "s", 4)] * 50 + [(3, "Other", "x", "s", 4)]
    assert found(rows(SCHEMA, *data)) == expected(data, lower)


def test_empty_table(rows):
    assert found(rows(SCHEMA, (1, "a", "x", "s", 1)).where("false")) == []


def test_nodes_name_their_parents(spark, rows):
    data = [(i, f"t{i}", "ab"[i % 2], None, 1) for i in range(40)]
    docs = rows(SCHEMA, *data)
    leaf = merkle.leaf_hash([F.col(c) for c in merkle.FIELDS])
    nodes = merkle.build(docs.select(F.col("lang").alias("grp"), F.col("doc_id").alias("id"), leaf.alias("leaf"), leaf.alias("start"))).nodes.collect()
    by_key = {(n["tree"], n["level"], n["pos"]): n for n in nodes}
    roots = [n for n in nodes if n["parent_level"] is None]
    assert len(by_key) == len(nodes) and len(roots) == 1
    for n in nodes:
        if n is not roots[0]:
            parent = by_key[n["parent_tree"], n["parent_level"], n["parent_pos"]]
            assert bytes(parent["children"][32 * n["slot"] : 32 * n["slot"] + 32]) == bytes(n["hash"])


def test_row_limit_is_left_as_it_was(spark, rows):
    before = spark.conf.get(merkle.ROW_LIMIT)
    found(rows(SCHEMA, (1, "a", "x", "s", 1)))
    assert spark.conf.get(merkle.ROW_LIMIT) == before


def test_query(spark, sf_dir):
    assert_same(QUERIES["op12_merkle"](spark, sf_dir), connect(sf_dir), ORACLES["op12_merkle"])
