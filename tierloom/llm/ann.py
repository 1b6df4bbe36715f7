"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

* Inner product is made a distance: each vector gets one more component that brings all to the length of the
  longest, queries get 0 there. Then the nearest vector is the one with the largest inner product.
* The tree is fitted on a bounded sample, ``SAMPLE`` vectors; its leaves then take every vector of the table.
* A query walks the tree with a priority queue of nodes, nearest centre first, and lists leaves in the order it
  reaches them. It visits the first of them, at least as many as hold enough candidates.
* How many are visited is calibrated: for a sample of queries the true neighbours are found by reading all
  vectors, and the visits are widened until ``RECALL`` of those neighbours lie in visited leaves.
* Queries and vectors meet by leaf. A leaf with many vectors or many visitors is cut into blocks, each block of
  vectors meeting each block of visitors, so a vector that fills a third of the table loads no task.

Tree, leaf sizes and calibration are bounded by parameters, not by the data.

Defined results: vectors that are null, empty, zero, hold a null or non-finite component, or have another length
than most vectors take no part, neither as queries nor as candidates. Equal scores go to the smaller id, a missing
id last. Repeated rows are candidates of their own, and each repeated query row is answered. With fewer candidates
than asked for, all are returned. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierloom.llm.shared import in_file_order, store

NEIGHBOURS = 20
# Vectors the tree is fitted on, its fan-out, and the sampled vectors each leaf should be left with.
SAMPLE, FAN_OUT, PER_LEAF = 20_000, 16, 8
# Queries that calibrate the visits, and the share of their true neighbours that must be reached.
CALIBRATORS, RECALL = 200, 0.94
# Vectors, and visitors, of one block of a leaf.
BLOCK = 4096
SEED = 7


@dataclass(frozen=True)
class Tree:
    """Centres of all nodes; ``children[n]`` are the nodes below ``n``, ``leaf[n]`` the number of a leaf, else -1."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    leaf: np.ndarray
    longest: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at every level."""
        points, out, todo = self.lifted(vectors), np.zeros(len(vectors), np.int64), [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            below = np.array(self.children[node])
            centres = self.centres[below]
            nearest = np.argmin((centres**2).sum(axis=1) - 2 * points[rows] @ centres.T, axis=1)
            todo += [(int(below[c]), rows[nearest == c]) for c in np.unique(nearest)]
        return out

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        point = np.append(query * (self.longest / np.linalg.norm(query)), 0.0)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
                continue
            below = self.children[node]
            for far, child in zip(((self.centres[list(below)] - point) ** 2).sum(axis=1).tolist(), below, strict=True):
                heapq.heappush(queue, (far, child))


def _means(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Cluster of each point by k-means; equal points stay together."""
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(10):
        member = np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)
        centres = np.stack([points[member == c].mean(axis=0) if (member == c).any() else centres[c] for c in range(len(centres))])
    return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)


def grow(vectors: np.ndarray, longest: float, leaves: int) -> Tree:
    """Tree over a sample with so many leaves, fewer if points are equal: the fullest leaf is split next."""
    rng = np.random.default_rng(SEED)
    points = Tree(np.zeros((0, 0)), (), np.zeros(0, int), longest).lifted(vectors)
    centres, children, rows_of = [points.mean(axis=0)], [()], {0: np.arange(len(points))}
    queue = [(-len(points), 0)]
    while queue and len(rows_of) < leaves:
        _, node = heapq.heappop(queue)
        rows = rows_of[node]
        member = _means(points[rows], min(FAN_OUT, leaves - len(rows_of) + 1), rng)
        groups = [rows[member == c] for c in np.unique(member)]
        if len(groups) == 1:
            continue
        del rows_of[node]
        children[node] = tuple(range(len(centres), len(centres) + len(groups)))
        for group in groups:
            rows_of[len(centres)] = group
            heapq.heappush(queue, (-len(group), len(centres)))
            centres.append(points[group].mean(axis=0))
            children.append(())
    leaf = np.full(len(centres), -1)
    leaf[list(rows_of)] = np.arange(len(rows_of))
    return Tree(np.stack(centres), tuple(children), leaf, longest)


def usable(vector: Column) -> Column:
    """True for a vector that takes part, apart from its length."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _best(scores: np.ndarray, query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the ``k`` best of one query; ``scores`` may be off by rounding."""
    scores = np.where(own, -np.inf, scores)
    bound = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
    near = np.flatnonzero((scores >= bound - 1e-9 * max(1.0, abs(bound))) & ~own if np.isfinite(bound) else ~own)
    exact = (vectors[near] * query).sum(axis=1)
    order = np.lexsort((ids[near], -exact))[:k]
    return near[order], exact[order]


def _top(name: str, k: int) -> Column:
    """Place among the candidates of a query row, best first."""
    return F.row_number().over(Window.partitionBy(name).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "at"))


def _truth(rows: DataFrame, asked: list, tree: Tree, width: int, k: int) -> DataFrame:
    """True neighbours of a few queries, each with the leaf it lies in; reads all vectors, in blocks."""
    queries, own_at = np.array([q["vector"] for q in asked]), np.array([q["at"] for q in asked])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, at = _matrix(batch.column(2), width), batch.column(0).to_numpy()
            ids = batch.column(1).fill_null(2**63 - 1).to_numpy()
            leaf, scores = tree.assign(vectors), queries @ vectors.T
            for number, line in enumerate(scores):
                places, exact = _best(line, queries[number], vectors, ids, at == own_at[number], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(places), pa.int32()), batch.column(0).take(pa.array(places)), batch.column(1).take(pa.array(places)), pa.array(exact), pa.array(leaf[places], pa.int64())],
                    ["query", "at", "vec_id", "score", "leaf"],
                )

    found = rows.mapInArrow(scan, "query int, at long, vec_id long, score double, leaf long")
    return found.withColumn("place", _top("query", k)).where(F.col("place") <= k).select("query", "leaf")


def calibrated(rows: DataFrame, queries: DataFrame, tree: Tree, width: int, k: int, recall: float = RECALL) -> int:
    """Least number of visited leaves with which the sampled queries reach enough of their true neighbours."""
    asked = queries.orderBy(F.xxhash64("at"), "at").limit(CALIBRATORS).collect()
    if not asked:
        return 1
    order = [{leaf: place for place, leaf in enumerate(tree.walk(np.array(q["vector"])))} for q in asked]
    places = [order[r["query"]][r["leaf"]] for r in _truth(rows, asked, tree, width, k).collect()]
    return int(np.quantile(places, recall, method="higher")) + 1 if places else 1


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    id_col: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the nearest found; ``is_query`` reads column ``vec_id``.

    Also ``query_at``: the place of the query row in the scan, unique where ids repeat.
    """
    spark = table.sparkSession
    source = in_file_order(table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")))
    rows = source.select(F.monotonically_increasing_id().alias("at"), "vec_id", "vector").where(usable(F.col("vector")))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    shapes = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"), F.max(length).alias("longest")).orderBy(F.desc("n"), "width").limit(1).collect()
    out = "query_id long, query_at long, rank int, vec_id long, score double"
    if not shapes:
        return spark.createDataFrame([], out)
    width, total, longest = shapes[0]
    rows = rows.where(F.size("vector") == width)

    share = min(1.0, 2 * SAMPLE / total)
    drawn = rows.where(F.pmod(F.xxhash64("at", F.lit(SEED)), F.lit(1_000_000)) < F.lit(math.ceil(share * 1_000_000)))
    sample = np.array([r[0] for r in drawn.orderBy(F.xxhash64("at"), "at").limit(SAMPLE).select("vector").collect()])
    tree = grow(sample, longest, max(1, min(round(math.sqrt(total) / 2), len(sample) // PER_LEAF)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], ["at", "vec_id", "vector", "leaf"])

    placed = store(rows.mapInArrow(place, "at long, vec_id long, vector array<double>, leaf long"), "placed")
    held = dict(placed.groupBy("leaf").agg(F.count("*")).collect())
    queries = placed.where(F.coalesce(is_query, F.lit(False)))
    visits = calibrated(placed.select("at", "vec_id", "vector"), queries, tree, width, k, recall)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, leaves = [], []
            for number, query in enumerate(_matrix(batch.column(2), width)):
                seen = reached = 0
                for leaf in tree.walk(query):
                    row.append(number)
                    leaves.append(leaf)
                    seen, reached = seen + 1, reached + held.get(leaf, 0)
                    if seen >= visits and reached > k:
                        break
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), *(batch.column(i).take(at) for i in range(3))], ["leaf", "query_at", "query_id", "query"])

    asked = store(queries.select("at", "vec_id", "vector").mapInArrow(visit, "leaf long, query_at long, query_id long, query array<double>"), "visits")
    came = dict(asked.groupBy("leaf").agg(F.count("*")).collect())
    cuts = spark.createDataFrame([(leaf, -(-held.get(leaf, 1) // BLOCK), -(-n // BLOCK)) for leaf, n in came.items()], "leaf long, vector_parts int, query_parts int")
    cuts = F.broadcast(cuts)

    def dealt(df: DataFrame, key: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(mine)
        return df.join(cuts, "leaf").select("*", part, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs)).drop("vector_parts", "query_parts")

    left = dealt(asked, "query_at", "query_parts", "vector_parts", "i", "j").groupBy("leaf", "i", "j")
    right = dealt(placed, "at", "vector_parts", "query_parts", "j", "i").groupBy("leaf", "i", "j")

    def meet(visitors: pa.Table, here: pa.Table) -> pa.Table:
        columns = [[], [], [], [], []]
        if visitors.num_rows and here.num_rows:
            vectors, at = _matrix(here["vector"].combine_chunks(), width), here["at"].to_numpy()
            ids = here["vec_id"].combine_chunks().fill_null(2**63 - 1).to_numpy()
            questions = _matrix(visitors["query"].combine_chunks(), width)
            query_at, query_id = visitors["query_at"].to_pylist(), visitors["query_id"].to_pylist()
            given = here["vec_id"].to_pylist()
            for start in range(0, len(questions), 256):
                scores = questions[start : start + 256] @ vectors.T
                for number, line in enumerate(scores, start):
                    places, exact = _best(line, questions[number], vectors, ids, at == query_at[number], k)
                    for column, values in zip(columns, ([query_id[number]] * len(places), [query_at[number]] * len(places), at[places].tolist(), [given[p] for p in places], exact.tolist()), strict=True):
                        column.extend(values)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "query_at", "at", "vec_id", "score"])

    found = left.cogroup(right).applyInArrow(meet, "query_id long, query_at long, at long, vec_id long, score double")
    return found.withColumn("rank", _top("query_at", k)).where(F.col("rank") <= k).select("query_id", "query_at", "rank", "vec_id", "score")
