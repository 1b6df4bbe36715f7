"""Spans and allocation against the offsets of the tokenizer library."""

import public_tokenizers
from tokenizers import Tokenizer

from tierloom.llm import token_counts as tc
from tierloom.llm.shared import read

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def offsets(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).offsets


def brute(text, sections):
    """Counts per section number (None: outside) by comparing every token with every section."""
    out = {}
    order = sorted(range(len(sections)), key=lambda i: (sections[i][1], sections[i][2]))
    for begin, end in spans_of(text):
        shares = [(min(end, sections[i][2]) - max(begin, sections[i][1]), -n, i) for n, i in enumerate(order)]
        best = max(shares, default=(0, 0, None))
        out[best[2] if best[0] > 0 else None] = out.get(best[2] if best[0] > 0 else None, 0) + 1
    return out


def spans_of(text):
    coder = tc.encoding(RANKS, PATTERN)
    import numpy as np

    lengths = np.array([len(coder.decode_single_token_bytes(i)) for i in coder.encode_ordinary(text)], int)
    return list(zip(*(x.tolist() for x in tc.spans(text.encode(), lengths)), strict=True))


def test_spans_are_the_library_offsets():
    for text in ("Hello  world, it's 12\n\n fine", "zażółć 你好 \U0001f600 ok", "", "a"):
        assert spans_of(text) == [tuple(o) for o in offsets(text)]


def test_documents_by_line(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    totals, lines = {}, {}
    for r in tc.token_counts(docs, RANKS, PATTERN).collect():
        totals[r["doc_id"]] = totals.get(r["doc_id"], 0) + r["n_tokens"]
        lines[r["doc_id"]] = lines.get(r["doc_id"], 0) + 1
    for r in docs.limit(60).collect():
        assert totals[r["doc_id"]] == len(offsets(r["text"])) and lines[r["doc_id"]] == r["text"].count("\n") + 1


def test_sections_against_brute_force(rows):
    text = "alpha beta gamma  delta\n\nepsilon übergang"
    cases = [[("a", 0, 8), ("b", 8, 13), ("c", 13, 18)], [("x", 0, 41), ("y", 4, 12), ("z", 4, 30)], [("e", 3, 3), ("o", 100, 200)], [("late", 20, 30), ("early", 0, 20)], []]
    docs = rows("doc_id long, text string, sections array<struct<section: string, begin: int, end: int>>, at string", *[(i, text, c, "clash") for i, c in enumerate(cases)])
    found = {}
    for r in tc.token_counts(docs, RANKS, PATTERN, sections="sections").collect():
        if r["n_tokens"]:
            found.setdefault(r["doc_id"], {})[r["section"]] = r["n_tokens"]
    for i, case in enumerate(cases):
        assert found[i] == {None if k is None else case[k][0]: n for k, n in brute(text, case).items()}


def test_crossing_goes_to_the_larger_share_then_the_earlier(rows):
    text = "that"  # one token
    assert len(offsets(text)) == 1
    docs = rows("doc_id long, text string, s array<struct<section: string, begin: int, end: int>>", (1, text, [("a", 0, 1), ("b", 1, 4)]), (2, text, [("a", 0, 2), ("b", 2, 4)]))
    found = {(r["doc_id"], r["section"]): (r["n_tokens"], r["n_crossing"]) for r in tc.token_counts(docs, RANKS, PATTERN, sections="s").collect()}
    assert found == {(1, "a"): (0, 0), (1, "b"): (1, 1), (2, "a"): (1, 1), (2, "b"): (0, 0)}


def test_defined_results(rows):
    docs = rows("doc_id long, text string", (None, None), (1, ""), (2, "a\n"), (2, "a\n"), (3, "word " * 40_000))
    found = tc.token_counts(docs, RANKS, PATTERN).collect()
    assert sorted((str(r["doc_id"]), r["section"]) for r in found) == sorted([("None", "0"), ("1", "0"), ("2", "0"), ("2", "1"), ("2", "0"), ("2", "1"), ("3", "0")])
    assert sum(r["n_tokens"] for r in found if r["doc_id"] == 3) == len(offsets("word " * 40_000))
    assert tc.token_counts(docs.limit(0), RANKS, PATTERN).collect() == []


def test_joined_fields(rows):
    row = tc.joined_fields(rows("a string, b string", ("xy", None)), ["a", "b"]).first()
    assert row["text"] == "xy\n" and [tuple(s) for s in row["sections"]] == [("a", 0, 2), ("b", 3, 3)]
