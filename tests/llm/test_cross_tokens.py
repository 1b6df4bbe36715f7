"""Alignment against whole-text encodings by both libraries, compared byte by byte."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierloom.llm import cross_tokens
from tierloom.llm.perfect_hash import PerfectHash
from tierloom.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, QUERIES
from tierloom.llm.shared import read

PATHS = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)
ODD = [
    None, "", " ", "  two  spaces ", "line\n\nbreaks\r\n and\ttabs", "<|endoftext|> and <s> </s> <unk>", "▁mark", "plain <0x41>", "\x00 zero", "wörter über ñ 日本語 🙂🙂 é",
    "no break em　wide", "it's they'll we'VE 12345 3.14", "a" * 3000, "x " * 2000, "ends with space ", "﻿bom ​ zero", " \n lead", "one", "a ▁ b good words", "\x1c \x85 odd spaces", "ﬁ Ⅷ ①",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    alphabet = cross_tokens.byte_alphabet()
    a_bytes = {n: bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode() for e, n in a.get_vocab().items()}
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        u, v = [a_bytes[i] for i in x], [b_bytes(i) for i in y]
        if not b"".join(u) == b"".join(v) == (" " + text).encode():
            return None
        return list(zip(x, itertools.accumulate(map(len, u), initial=0), itertools.accumulate(map(len, u)))), list(zip(y, itertools.accumulate(map(len, v), initial=0), itertools.accumulate(map(len, v))))

    return tokens


def expected(texts, tokens):
    """Per text the numbers and the groups as text, by plain loops."""
    aligned = []
    for text in texts:
        found = tokens(text)
        if found is None:
            aligned.append(None)
            continue
        a, b = found
        links, j = [], 0
        for i, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        x, y = 0, 0
        for cut in cuts:
            left, right = [], []
            while x < len(a) and a[x][2] <= cut:
                left.append(str(a[x][0]))
                x += 1
            while y < len(b) and b[y][2] <= cut:
                right.append(str(b[y][0]))
                y += 1
            groups.append(",".join(left) + "|" + ",".join(right))
            low = cut
        assert low == a[-1][2] == b[-1][2]
        aligned.append((len(a), len(b), links, groups))
    counts = Counter(pair for found in aligned if found for pair in set(found[2]))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for found in aligned:
        if found is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, groups = found
            out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), ";".join(groups)))
    return out, counts, most


def test_documents(spark, sf_dir, libraries):
    texts = {r["doc_id"]: r["text"] for r in read(spark, sf_dir, "documents").collect()}
    want = dict(zip(texts, expected(texts.values(), libraries)[0], strict=True))
    found = QUERIES["op13_cross_tokens"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        *numbers, groups = want[row["doc_id"]]
        assert list(row)[1:7] == numbers
        assert row["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_odd_texts_in_many_parts(rows, libraries, monkeypatch):
    """Several rows of a shard are merged in a tree; texts, groups, counts and clashing columns are right."""
    monkeypatch.setattr(cross_tokens, "FAN_IN", 2)
    texts = ODD + ["good words and other words"] * 5
    want, counts, most = expected(texts, libraries)
    docs = rows("doc_id long, text string, shard string, part int, n_a int, k0 int", *[(i, t, "s", 1, 2, 3) for i, t in enumerate(texts)]).repartition(9)
    found = sorted(map(tuple, cross_tokens.align(docs, *PATHS, groups=True).collect()))
    assert [r[1:7] + r[8:] for r in found] == want
    pairs = cross_tokens.pair_counts(docs, *PATHS).collect()
    assert {(r["a"], r["b"]): r["documents"] for r in pairs} == counts and len(pairs) == len(counts)
    assert all(r["best"] == (counts[r["a"], r["b"]] == most[r["a"]]) for r in pairs)


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text union all select cast(null as bigint), 'fine words'")
    found = {r["doc_id"]: r for r in cross_tokens.align(docs, *PATHS).collect()}
    assert (found[1]["n_a"], found[1]["groups_sha256"]) == (0, "") and found[None]["n_a"] > 0


def test_empty_table(rows):
    docs = rows("doc_id long, text string", (1, "a")).where("false")
    assert cross_tokens.align(docs, *PATHS).collect() == [] and cross_tokens.pair_counts(docs, *PATHS).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 200_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(2**31, n, replace=False).astype(np.int64)
    stored = PerfectHash.of(keys)
    again = PerfectHash(stored.sizes, stored.packed)
    assert np.array_equal(np.sort(again.index(keys)), np.arange(n))
    if n >= 1000:
        assert len(again.packed) * 8 < 6 * n
