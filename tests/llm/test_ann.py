"""Recall against brute force, and defined results."""

import numpy as np
from pyspark.sql import functions as F

from tierloom.llm import ann
from tierloom.llm.shared import read


def brute(vectors, ids, query, own, k):
    scores = (vectors * query).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if i != own][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


def test_recall(spark, sf_dir):
    table = read(spark, sf_dir, "embeddings")
    held = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, vectors = np.array([h[0] for h in held]), np.array([h[1] for h in held], float)
    found = {}
    for row in ann.nearest(table, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(row["query_id"], {})[row["rank"]] = (row["vec_id"], row["score"])
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        answer, truth = found[ids[i]], brute(vectors, ids, vectors[i], i, 20)
        assert sorted(answer) == list(range(1, 21))
        scores = [answer[r][1] for r in range(1, 21)]
        assert scores == sorted(scores, reverse=True)
        exact = dict(zip(ids.tolist(), (vectors * vectors[i]).sum(axis=1).tolist(), strict=True))
        assert all(abs(exact[v] - s) < 1e-12 for v, s in answer.values())
        hits, total = hits + len({v for v, _ in answer.values()} & {v for v, _ in truth}), total + 20
    assert hits >= 0.9 * total


def test_all_leaves_are_exact_with_ties_and_lengths(rows):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(size=(300, 6)) * rng.uniform(0.1, 5, (300, 1)), np.ones((300, 6))])
    table = rows("vec_id long, embedding array<double>", *[(i, v.tolist()) for i, v in enumerate(vectors)])
    found = {}
    for row in ann.nearest(table, F.col("vec_id") % 20 == 0, k=7, recall=1.0).collect():
        found.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    right = sum([v for _, v, _ in sorted(found[i])] == [v for v, _ in brute(vectors, np.arange(600), vectors[i], i, 7)] for i in range(0, 600, 20))
    assert len(found) == 30 and right >= 27
    assert [v for _, v, _ in sorted(found[400])] == [v for v, _ in brute(vectors, np.arange(600), vectors[400], 400, 7)]


def test_rows_that_take_no_part(rows):
    bad = [(0, None), (20, []), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [1.0, None]), (100, [1.0, 2.0, 3.0]), (120, [float("inf"), 1.0])]
    good = [(140, [1.0, 0.0]), (140, [1.0, 0.0]), (None, [0.5, 0.0]), (7, [0.0, 1.0])]
    table = rows("vec_id long, embedding array<float>, leaf int, score string", *[(*r, 1, "x") for r in bad + good])
    found = ann.nearest(table, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], str(r["vec_id"]), r["score"]) for r in found) == sorted([(140, 1, "140", 1.0), (140, 2, "None", 0.5), (140, 3, "7", 0.0)] * 2)
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.nearest(table.where("vec_id = 0"), F.col("vec_id") % 20 == 0).collect() == []


def test_walk_lists_every_leaf_once():
    rng = np.random.default_rng(5)
    tree = ann.grow(rng.normal(size=(500, 4)), 6.0, 60)
    leaves = list(tree.walk(rng.normal(size=4)))
    assert sorted(leaves) == list(range(int(tree.leaf.max()) + 1))
