"""Near-duplicates: MinHash minima, banding, verification by signature and by full sets, components.

1. One pass over the texts gives each row a digest of its word sequence, the size of its shingle set and the
   minima of many universal hash functions. Rows with equal words become one node, so copies cost nothing
   further on.
2. Bands of the minima are grouped. In each group one hub is chosen, the node that meets most others over all
   bands, and every member is compared with it: first by signature, then on the full sets. A group of n
   members gives n pairs.
3. A member linked to a hub takes the hub's label. Groups that still hold several labels are compared in
   blocks, two blocks in a task, with their signatures and full texts. There, pairs of different labels whose
   signatures agree are confirmed on full sets, each pair in the first band it shares; a confirmed pair joins its
   labels, and only confirmed pairs leave the task: fewer than the block has labels.
4. Components of all links.

No step limits the members of a group or the partners of a row. What can be missed is a link whose ends agree
in no band, or whose signatures differ too much: see ``BANDS`` and ``SLACK``.

Defined results: a null, empty or blank text has no shingles and is linked with nothing. A text with fewer
words than a shingle is one shingle. Repeated rows belong to one component. A component's id is the smallest
id of its rows; rows without an id count in it, but have no part in the minimum. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierloom.llm import bloom
from tierloom.llm.components import components
from tierloom.llm.shared import in_file_order, rows_at, store

# 32 bands of 5 minima: sets with a similarity of 0.8 agree in a band but for 3 in a million.
BANDS, ROWS = 32, 5
# A pair is dropped if the signatures' agreement is this far below the threshold: 5 standard deviations, as rare as a miss of the bands.
SLACK = 0.16
# Members of one block when a group is compared in blocks.
BLOCK = 1000
# Words a task keeps numbered at a time.
NUMBERED = 250_000
SEED = 20_011
SIGNED = "at long, id {id}, digest binary, n_shingles long, signature binary, short binary"


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of strongly universal functions of 32 bits (multiply, add, shift)."""
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, count, dtype=np.uint64)
    return draw() | np.uint64(1), draw()


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a sequence of word hashes."""
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : i + n]
    out ^= out >> np.uint64(32)
    return np.unique(out * np.uint64(0x94D049BB133111EB))


def minima(shingles: np.ndarray, multiply: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Least value of each function over the shingles."""
    folded = shingles >> np.uint64(32)
    least = np.full(len(multiply), 2**32 - 1, np.uint64)
    for start in range(0, len(folded), 2048):
        part = folded[None, start : start + 2048] * multiply[:, None]
        part += add[:, None]
        part >>= np.uint64(32)
        np.minimum(least, part.min(axis=1), out=least)
    return least.astype("<u4")


def sign(rows: DataFrame, words: int, count: int) -> DataFrame:
    """Digest, set size, signature and the last bytes of the signature's minima, of each row of (at, id, text)."""
    multiply, add = _functions(count)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        numbers, hashes = _Numbers(), np.zeros(0, np.uint64)
        for batch in batches:
            if len(numbers) > NUMBERED:
                numbers, hashes = _Numbers(), np.zeros(0, np.uint64)
            digests, sequences = [], []
            for value in batch.column(2).to_pylist():
                found = value.lower().split() if value else ()
                digests.append(hashlib.blake2b(b" ".join(found), digest_size=16).digest() if found else None)
                sequences.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
            new = list(numbers)[len(hashes) :]
            hashes = np.concatenate([hashes, np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))])
            sets = [shingle_hashes(hashes[s], words) for s in sequences]
            signatures = [minima(s, multiply, add) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(digests, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([None if s is None else s.tobytes() for s in signatures], pa.binary()),
                    pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in signatures], pa.binary()),
                ],
                ["at", "id", "digest", "n_shingles", "signature", "short"],
            )

    return rows.mapInArrow(signed, SIGNED.format(id=rows.schema["id"].dataType.simpleString()))


def _agreement(pairs: DataFrame, nodes: DataFrame, percent: int, floor: float) -> DataFrame:
    """Pairs whose set sizes and signatures allow the similarity that is asked for."""
    enough = F.expr(f"100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)")
    facts = nodes.select("node", "n_shingles", "short")
    a, b = facts.toDF("a", "size_a", "short_a"), facts.toDF("b", "size_b", "short_b")
    met = pairs.join(a, "a").join(b, "b").where(enough)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            keep = pa.array(_same_share(left == right) >= floor) if batch.num_rows else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return met.select("a", "b", "short_a", "short_b").mapInArrow(close, "a long, b long")


def _same_share(equal: np.ndarray) -> np.ndarray:
    """Share of equal minima, from their last bytes; other minima agree in one of 256."""
    return (equal.mean(axis=-1) - 1 / 256) / (255 / 256)


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the wanted nodes. A Bloom filter keeps most other texts out of the shuffle."""
    blocks = bloom.block_count(wanted.count())
    texts = rows.select(F.col("at").alias("node"), "text")
    if bloom.fits(blocks):
        texts = bloom.probe(texts, "node", store(bloom.build(wanted, "node", blocks), "bloom"), blocks).where("maybe").drop("maybe")
    return store(texts.join(wanted, "node"), "texts")


def confirm(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are as similar as asked for; exact."""
    pairs = store(pairs, "pairs")
    texts = _texts(rows, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    met = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = [None, frozenset()]
        for batch in batches:
            keep = []
            for a, left, right in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if last[0] != a:
                    last = [a, shingles(left, words)]
                other = shingles(right, words)
                common = len(last[1] & other)
                keep.append(100 * common >= percent * (len(last[1]) + len(other) - common))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    return store(met.mapInArrow(similar, "a long, b long"), "links")


def shingles(text: bytes, words: int) -> frozenset:
    """Distinct shingles of a text, as words."""
    found = text.lower().split()
    if len(found) < words:
        return frozenset([b" ".join(found)] if found else ())
    return frozenset(zip(*(found[i:] for i in range(words)), strict=False))


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Each member of a group with the hub of the group."""
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    best = members.join(weight, "node").groupBy("band").agg(F.max(F.struct("weight", -F.col("node"))).alias("best"))
    hubs = store(best.select("band", (-F.col("best.col2")).alias("hub")), "hubs")
    met = members.join(hubs, "band").where("node <> hub")
    return met.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def _block_links(members: DataFrame, nodes: DataFrame, rows: DataFrame, links: DataFrame, words: int, percent: int, bands: int, floor: float) -> DataFrame:
    """Links between different labels in groups that hold several, enough of them to join all labels that are linked.

    A node's label is the least hub it is linked to; a hub without another hub is its own. Equal labels are linked.
    """
    own = links.select(F.col("a").alias("node"), F.col("a").alias("label"))
    labels = links.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(own).groupBy("node").agg(F.min("label").alias("label"))
    labelled = members.select("band", "no", "node").join(labels, "node", "left").select("band", "no", "node", F.coalesce("label", "node").alias("label"))
    labelled = store(labelled, "labelled")
    groups = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    mixed = store(groups.where("low < high").select("band", "size"), "mixed")
    held = store(labelled.join(mixed, "band"), "held")

    texts = _texts(rows, held.select("node").distinct())
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), parts).cast("int")
    dealt = held.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select("band", "no", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "label")
    dealt = dealt.join(nodes.select("node", "n_shingles", "signature"), "node").join(texts, "node")

    def compare(group: pa.Table) -> pa.Table:
        i, j, no = (group[c][0].as_py() for c in ("i", "j", "no"))
        mine, node, label, size = (group[c].to_numpy() for c in ("mine", "node", "label", "n_shingles"))
        label, given = label.copy(), group["text"]
        signature = np.frombuffer(b"".join(group["signature"].to_pylist()), "<u4").reshape(len(node), bands, -1)
        sets: dict[int, frozenset] = {}

        def full(at: int) -> frozenset:
            if at not in sets:
                sets[at] = shingles(given[at].as_py(), words)
            return sets[at]

        found = []
        here, there = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        for place, at in enumerate(here):
            over = there if i != j else here[place + 1 :]
            over = over[(label[over] != label[at]) & (100 * np.minimum(size[over], size[at]) >= percent * np.maximum(size[over], size[at]))]
            if not len(over):
                continue
            equal = signature[over] == signature[at]
            share = equal.mean(axis=(1, 2))
            near = np.flatnonzero((share >= floor) & (np.argmax(equal.all(axis=2), axis=1) == no))
            for other in over[near[np.argsort(-share[near], kind="stable")]]:
                if label[other] == label[at]:
                    continue
                left, right = full(at), full(other)
                common = len(left & right)
                if 100 * common >= percent * (len(left) + len(right) - common):
                    found.append((node[at], node[other]))
                    label[label == label[other]] = label[at]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return store(dealt.groupBy("band", "no", "i", "j").applyInArrow(compare, "a long, b long"), "rest")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``at`` (its place in the scan), ``id``, ``n_shingles``, ``component_id``, and ``first`` (true for one row of a component).

    ``at`` is unique, also where ids repeat.
    """
    source = in_file_order(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")))
    rows = source.select(F.monotonically_increasing_id().alias("at"), "id", "text")
    floor = percent / 100 - SLACK
    signed = store(sign(rows, words, BANDS * ROWS), "signed")

    # The row that stays is the one with the least id, then the least place.
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "at")).alias("least")
    nodes = signed.where("digest is not null").groupBy("digest").agg(F.min("at").alias("node"), least, *[F.min(c).alias(c) for c in ("n_shingles", "signature", "short")])
    nodes = store(nodes, "nodes")

    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("signature", 4 * ROWS * i + 1, 4 * ROWS)) for i in range(BANDS)])
    banded = nodes.select("node", F.posexplode(keys).alias("no", "band"))
    shared = store(banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    members = store(banded.join(shared, "band"), "members")

    first = confirm(_agreement(_hub_pairs(members), nodes, percent, floor), rows, words, percent)
    rest = _block_links(members, nodes, rows, first, words, percent, BANDS, floor)
    merged = components(first.unionByName(rest)).withColumnRenamed("component", "root")

    owned = nodes.select("node", "digest", "least").join(merged, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    roots = store(owned.groupBy("root").agg(F.min("least").alias("first")), "roots")
    digests = store(owned.join(roots, "root").select("digest", "first"), "digests")
    placed = signed.drop("signature", "short").join(digests, "digest", "left")
    # A row without shingles has no digest and is a component by itself.
    alone = F.col("digest").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("first.id"))
    return placed.select("at", "id", "n_shingles", component.alias("component_id"), (alone | (F.col("at") == F.col("first.at"))).alias("first"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each component, all columns kept."""
    source = in_file_order(docs)
    return rows_at(source, near_duplicates(source, words, percent, id_col, text).where("first"), "_at")
