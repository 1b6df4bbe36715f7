"""Scores against a model in plain Python; the sequences against a dictionary."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tierloom.llm import ngram_lm
from tierloom.llm.elias_fano import EliasFano
from tierloom.llm.shared import read


def model(texts):
    """Rows by plain counting: (id, held out, tokens, known, N, base, score)."""
    split = [(i, (t or "").encode().lower().split()) for i, t in texts]
    learn = [w for i, w in split if i is not None and zlib.crc32(str(i).encode()) % 10]
    words = Counter(x for w in learn for x in (*w, b"\n"))
    pairs = Counter(p for w in learn for p in zip([b"\t", *w], [*w, b"\n"], strict=True))
    contexts = Counter(x for w in learn for x in (b"\t", *w))
    total, distinct = sum(words.values()), len(words)
    base = lambda x: (words[x] + 0.1) / (total + 0.1 * (distinct + 1))
    for i, w in split:
        tokens, before = [*w, b"\n"], [b"\t", *w]
        full = sum(math.log10((pairs[h, x] + ngram_lm.MU * base(x)) / (contexts[h] + ngram_lm.MU)) for h, x in zip(before, tokens, strict=True))
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        yield (str(i), held, len(tokens), sum(words[x] > 0 for x in tokens), total, sum(math.log10(base(x)) for x in tokens), full)


def assert_scores(found, texts):
    got, want = (sorted(x, key=str) for x in ([(str(r[0]), *r[1:]) for r in found], model(texts)))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert abs(g[5] - w[5]) < 1e-6 * w[2] and abs(g[6] - w[6]) < 3e-4 * w[2]


def test_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = ngram_lm.score(docs).collect()
    assert_scores(found, [(r["doc_id"], r["text"]) for r in docs.collect()])
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.2 * sum(r["n_tokens"] for r in held)


def test_defined_results(rows):
    data = [(None, None), (None, "the cat"), (1, ""), (1, ""), (2, " \t\n"), (3, "The THE\x0bthe cat"), (4, "a " * 30_000)]
    docs = rows("doc_id long, text string, bucket int, learn string", *[(*d, 1, "x") for d in data])
    assert_scores(ngram_lm.score(docs).collect(), data)
    assert ngram_lm.score(docs.limit(0)).collect() == []


def test_nothing_to_learn_from(rows):
    found = ngram_lm.score(rows("doc_id long, text string", (None, "a b"))).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in found] == [(3, 0, 0, 0.0)]


def test_small_chunks_and_hot_words_give_the_same(rows, spark, monkeypatch, tmp_path):
    data = [(i, f"the {i % 7} the {i % 11} the hot {i}") for i in range(200)]
    rows("doc_id long, text string", *data).repartition(3).write.parquet(str(tmp_path / "docs"))
    monkeypatch.setattr(ngram_lm, "CHUNK", 400)
    assert_scores(ngram_lm.score(spark.read.parquet(str(tmp_path / "docs"))).collect(), data)


@pytest.mark.parametrize("top", [50, 10**6, 2**40, 2**64 - 1])
def test_elias_fano(top, tmp_path):
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, top, 3000, dtype=np.uint64, endpoint=True))
    EliasFano.build(values).save(tmp_path, "x")
    asked = np.concatenate([values, rng.integers(0, top, 3000, dtype=np.uint64, endpoint=True), np.array([0, top], np.uint64)])
    at = {int(v): i for i, v in enumerate(values)}
    assert EliasFano.open(tmp_path, "x").find(asked).tolist() == [at.get(int(v), -1) for v in asked]


def test_elias_fano_of_nothing():
    assert EliasFano.build(np.zeros(0, np.uint64)).find(np.array([0, 5], np.uint64)).tolist() == [-1, -1]


def test_quantised_probabilities():
    p = np.array([1.0, 0.5, 1e-6, 1e-30])
    back = ngram_lm.restored(ngram_lm.quantised(p))
    assert np.allclose(np.log10(back[:3]), np.log10(p[:3]), atol=1e-4) and back[3] == 1e-12
    assert ngram_lm.restored(np.zeros(1, "<u2"))[0] == 0


@pytest.mark.parametrize("top", [50, 10**6, 2**40, 2**64 - 1])
def test_numbers_at_places_and_searches_in_ranges(top, tmp_path):
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, top, 3000, dtype=np.uint64, endpoint=True))
    EliasFano.build(values).save(tmp_path, "x")
    sequence = EliasFano.open(tmp_path, "x")
    assert np.array_equal(sequence.at(np.arange(len(values))), values)
    first = rng.integers(0, len(values), 4000)
    stop = np.minimum(first + rng.integers(0, 40, 4000), len(values))
    asked = values[np.minimum(first + rng.integers(0, 45, 4000), len(values) - 1)]
    want = [next((i for i in range(a, b) if values[i] == v), -1) for v, a, b in zip(asked, first, stop, strict=True)]
    assert sequence.find(asked, first, stop).tolist() == want


def test_trie_against_a_dictionary(tmp_path):
    rng = np.random.default_rng(3)
    context, word = rng.integers(0, 300, 5000, dtype=np.uint64) * 2**50, rng.integers(0, 400, 5000, dtype=np.uint64) * 2**49
    counts = Counter(zip(context.tolist(), word.tolist(), strict=True))
    totals = Counter(context.tolist())
    ngram_lm.Trie.write(tmp_path, context, word, np.ones(5000), {int(context[0]): 77_777})
    trie = ngram_lm.Trie(tmp_path)
    asked = rng.integers(0, 320, 200, dtype=np.uint64) * 2**50
    length = rng.integers(1, 60, 200)
    words = rng.integers(0, 420, int(length.sum()), dtype=np.uint64) * 2**49
    found, levels = trie.answer(asked, length, words)
    of = lambda c: 77_777 if c == context[0] else totals[c]
    assert found.tolist() == [of(c) for c in asked.tolist()]
    want = [counts[c, w] / (of(c) + ngram_lm.MU) for c, w in zip(np.repeat(asked, length).tolist(), words.tolist(), strict=True)]
    assert np.allclose(ngram_lm.restored(levels), want, rtol=1e-3) and np.count_nonzero(want) > 100
    # The ranges of the contexts follow each other: pointers rise from 0 to the number of pairs.
    starts = trie.starts.at(np.arange(trie.starts.n))
    assert starts[0] == 0 and starts[-1] == len(counts) == trie.successors.n and trie.starts.n == len(totals) + 1
