"""Language model scoring with an n-gram trie in Elias-Fano levels.

The model is a bigram model with Dirichlet smoothing over a unigram base:

    P(w | h) = (c(h, w) + MU * P(w)) / (c(h) + MU),   P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1))

with a start mark as the first context and an end mark as the last word of a text.

* Scan tasks gather rows to chunks and send each distinct pair of a chunk once, with its count in training
  texts, to the bucket of its context. So what is shuffled follows the distinct pairs of chunks.
* A bucket adds up the counts and writes its part of the trie. The first level holds the contexts, and for each a
  pointer to its first successor; the second holds the successors of all contexts, one range after the other, each
  written relative to the end of the range before it, with the probabilities quantised to 16 bits. Contexts, pointers
  and successors are rising sequences in Elias-Fano form, in files that are memory-mapped while the task reads them.
  A successor is searched within the range between the pointer of its context and the next one.
* Each chunk gets, in the order it sent its pairs, their probabilities and the counts of the contexts, and scores its
  texts. As every word of a text is also a context, those counts are all that the unigram base needs.
* A context with more than 1 / ``HOT`` of all tokens is dealt to several buckets by successor; there are fewer than
  ``HOT`` of them, and their counts are known to all tasks.

Words are compared by 64-bit hashes. Counts and statistics cover all training texts; nothing is pruned.

Defined results: a null, empty or blank text consists of the end mark alone. Rows without an id are scored, but
neither learned from nor held out. Repeated rows count as often as they occur. Without training texts every token has
the base probability of an unknown word. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierloom.llm.elias_fano import EliasFano
from tierloom.llm.shared import chunks, in_file_order, is_held_out, learned_from, pack_chunks, store, unpacked

FOLDS = 10
# Weight of the unigram base, in counts.
MU = 4.0
HOT = 2000
# Words of the vocabulary that a bucket has: the number of buckets follows the vocabulary, not the cluster.
WORDS_PER_BUCKET = 16_384
CHUNK = 12_000_000
# Quantised probabilities: 0 for a pair that was not seen, else steps of the logarithm down to 10 ** -RANGE.
RANGE, LEVELS = 12.0, 65_534
# Marks that no word equals, as words have no white space.
START, END = b" start", b" end"


def _hashed(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


@dataclass
class Pairs:
    """Distinct (context, successor) pairs of a chunk, in the order in which buckets get and answer them."""

    hashes: np.ndarray
    contexts: np.ndarray
    successors: np.ndarray
    counts: np.ndarray
    layout: np.ndarray
    bounds: np.ndarray
    token_context: np.ndarray
    token_word: np.ndarray
    token_pair: np.ndarray
    offsets: np.ndarray

    def part(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a bucket, and where in them a new context begins."""
        pairs = self.layout[self.bounds[bucket] : self.bounds[bucket + 1]]
        own = self.contexts[pairs]
        return pairs, np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(pairs) else pairs


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def pairs_of(texts: list[bytes | None], learn: np.ndarray, hot: dict[int, int], share: float, buckets: int) -> Pairs:
    """Pairs of a chunk of texts. ``hot`` has the counts of heavy contexts by hash, ``share`` what one bucket should take."""
    numbers = _Numbers({START: 0, END: 1})
    found = [np.fromiter(map(numbers.__getitem__, text.lower().split()), np.int64) if text else np.zeros(0, np.int64) for text in texts]
    lengths = np.array([len(f) + 1 for f in found], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    context, word = np.zeros(offsets[-1], np.int64), np.ones(offsets[-1], np.int64)
    for start, f in zip(offsets, found, strict=False):
        word[start : start + len(f)] = f
        context[start + 1 : start + 1 + len(f)] = f
    hashes = _hashed(list(numbers))
    home = (hashes % np.uint64(buckets)).astype(np.int64)
    by_home, by_hash = np.lexsort((hashes, home)), np.argsort(hashes)
    place_home, place_hash = np.empty_like(by_home), np.empty_like(by_hash)
    place_home[by_home], place_hash[by_hash] = np.arange(len(hashes)), np.arange(len(hashes))
    code, pair = np.unique(place_home[context] * len(hashes) + place_hash[word], return_inverse=True)
    contexts, successors = by_home[code // len(hashes)], by_hash[code % len(hashes)]
    counts = np.bincount(pair, weights=np.repeat(learn, lengths), minlength=len(code)).astype(np.int64)

    parts = np.ones(len(hashes), np.uint64)
    for number, value in enumerate(hashes.tolist()):
        if value in hot:
            parts[number] = max(1, int(np.ceil(hot[value] / share)))
    spread = (hashes[successors] >> np.uint64(20)) % parts[contexts]
    bucket = ((home[contexts].astype(np.uint64) + spread) % np.uint64(buckets)).astype(np.int64)
    layout = np.argsort(bucket.astype(np.uint16) if buckets <= 65_536 else bucket, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    return Pairs(hashes, contexts, successors, counts, layout, bounds, context, word, pair, offsets)


def _narrow(values: np.ndarray) -> bytes:
    """A width byte, then the numbers in as few bytes each."""
    top = int(values.max()) if values.size else 0
    width = next(w for w in (1, 2, 4, 8) if top < 256**w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _wide(value: bytes) -> np.ndarray:
    return np.frombuffer(value, f"<u{value[0]}", offset=1)


def quantised(probability: np.ndarray) -> np.ndarray:
    return (1 + np.round((np.maximum(np.log10(probability), -RANGE) + RANGE) / RANGE * (LEVELS - 1))).astype("<u2")


def restored(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, 10 ** ((level.astype(float) - 1) / (LEVELS - 1) * RANGE - RANGE), 0.0)


SEQUENCES = ("contexts", "starts", "words", "successors")


class Trie:
    """The pairs of one bucket: two levels in a folder of files, read through memory maps."""

    def __init__(self, folder: Path) -> None:
        self.contexts, self.starts, self.words, self.successors = (EliasFano.open(folder, n) for n in SEQUENCES)
        self.totals, self.levels = (np.load(folder / f"{n}.npy", mmap_mode="r") for n in ("totals", "levels"))

    @staticmethod
    def write(folder: Path, context: np.ndarray, word: np.ndarray, count: np.ndarray, hot: dict[int, int]) -> None:
        """Add up the counts of equal pairs and write the levels; ``hot`` has totals of contexts that lie in many buckets."""
        contexts, of = np.unique(context, return_inverse=True)
        words, rank = np.unique(word, return_inverse=True)
        codes, pair = np.unique(of * len(words) + rank, return_inverse=True)
        counts = np.bincount(pair, weights=count, minlength=len(codes))
        owner, rank = np.divmod(codes, max(len(words), 1))
        totals = np.bincount(owner, weights=counts, minlength=len(contexts)).astype(np.int64)
        for i, value in enumerate(contexts.tolist()):
            totals[i] = hot.get(value, totals[i])
        ends = np.cumsum(np.bincount(owner, minlength=len(contexts)))
        # A range begins where the one before it ended, so that all of them together rise.
        widths = rank[ends - 1] + 1
        successors = rank + (np.cumsum(widths) - widths)[owner]
        for name, values in zip(SEQUENCES, (contexts, np.concatenate([[0], ends]), words, successors), strict=True):
            EliasFano.build(values).save(folder, name)
        np.save(folder / "totals.npy", totals)
        np.save(folder / "levels.npy", quantised(counts / (totals[owner] + MU)) if len(codes) else np.zeros(0, "<u2"))

    def answer(self, context: np.ndarray, length: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count of each context, and the quantised probability of its successors, ``length`` of them.

        Contexts and words are looked up once each; then every successor is searched in the range of its context.
        """
        distinct, of = np.unique(context, return_inverse=True)
        at = self.contexts.find(distinct)
        there = np.flatnonzero(at >= 0)
        held = at[there]
        totals, first, stop, base = (np.zeros(len(distinct), np.int64) for _ in range(4))
        totals[there] = self.totals[held]
        first[there], stop[there] = self.starts.at(held), self.starts.at(held + 1)
        later = there[first[there] > 0]
        base[later] = self.successors.at(first[later] - 1).astype(np.int64) + 1
        distinct, place = np.unique(word, return_inverse=True)
        rank = self.words.find(distinct)[place]
        owner = np.repeat(of, length)
        known = np.flatnonzero((at[owner] >= 0) & (rank >= 0))
        owner = owner[known]
        pair = self.successors.find(base[owner] + rank[known], first[owner], stop[owner])
        out = np.zeros(len(word), "<u2")
        out[known[pair >= 0]] = self.levels[pair[pair >= 0]]
        return totals[of], out


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10)."""
    key = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    rows = in_file_order(given).select("id", is_held_out(F.col("id"), folds).alias("held_out"), learned_from(F.col("id"), folds).alias("learn"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counter.update(value.lower().split() if value else ())
                counter[END] += 1
            if len(counter) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], ["word", "n"])
                counter = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], ["word", "n"])

    words = store(rows.where("learn").select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    distinct, total = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(64, -(-distinct // WORDS_PER_BUCKET))
    heavy = {bytes(r["word"]): r["n"] for r in words.where(F.col("n") * HOT > total).collect()}
    ends = int(words.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    heavy = {w: n for w, n in heavy.items() if w != END} | ({START: ends} if ends * HOT > total else {})
    hot = dict(zip(_hashed(list(heavy)).tolist(), heavy.values(), strict=True))
    share = max(total / HOT, 1.0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table in chunks(batches, "text", CHUNK):
            found = pairs_of(table["text"].to_pylist(), table["learn"].to_numpy().astype(float), hot, share, buckets)
            for bucket in np.flatnonzero(np.diff(found.bounds)).tolist():
                pairs, starts = found.part(bucket)
                context = found.hashes[found.contexts[pairs[starts]]]
                sent = (context.tobytes(), _narrow(np.diff(np.append(starts, len(pairs)))), found.hashes[found.successors[pairs]].tobytes(), _narrow(found.counts[pairs]))
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([v], pa.binary()) for v in (name, *sent))], ["bucket", "chunk", "contexts", "lengths", "words", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        asked = [
            (np.frombuffer(c, np.uint64), _wide(n).astype(np.int64), np.frombuffer(w, np.uint64), _wide(k).astype(np.int64))
            for c, n, w, k in zip(*(group[x].to_pylist() for x in ("contexts", "lengths", "words", "counts")), strict=True)
        ]
        context = np.concatenate([np.repeat(c, n)[k > 0] for c, n, _, k in asked])
        word = np.concatenate([w[k > 0] for _, _, w, k in asked])
        seen = np.concatenate([k[k > 0] for *_, k in asked])
        with tempfile.TemporaryDirectory() as folder:
            Trie.write(Path(folder), context, word, seen, hot)
            del context, word, seen
            totals, levels = Trie(Path(folder)).answer(*(np.concatenate([a[i] for a in asked]) for i in range(3)))
        cuts = [np.cumsum([len(a[i]) for a in asked])[:-1] for i in (0, 2)]
        totals = [_narrow(part) for part in np.split(totals, cuts[0])]
        levels = [part.tobytes() for part in np.split(levels, cuts[1])]
        return pa.table([group["bucket"], group["chunk"], pa.array(totals, pa.binary()), pa.array(levels, pa.binary())], ["bucket", "chunk", "totals", "levels"])

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = {b: (t, v) for b, t, v in zip(*(right[c].to_pylist() for c in ("bucket", "totals", "levels")), strict=True)}
        out = []
        for value in left["rows"].to_pylist():
            table = unpacked(value)
            texts = table["text"].to_pylist()
            table = table.drop_columns(["text"])
            found = pairs_of(texts, np.zeros(len(texts)), hot, share, buckets)
            out.append(_scores(table, found, answers, hot, ends, total, distinct))
        return pa.concat_tables(out)

    answered = rows.mapInArrow(send, "bucket int, chunk binary, contexts binary, lengths binary, words binary, counts binary").groupBy("bucket").applyInArrow(answer, "bucket int, chunk binary, totals binary, levels binary")
    schema = f"id {key}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = pack_chunks(rows, "text", CHUNK).groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(place, schema)
    return scored.withColumnRenamed("id", id_col)


def _scores(table: pa.Table, found: Pairs, answers: dict, hot: dict[int, int], ends: int, total: int, distinct: int) -> pa.Table:
    """Scores of the rows of one chunk from the answers of the buckets."""
    level, known = np.zeros(len(found.contexts), "<u2"), np.zeros(len(found.hashes), np.int64)
    for bucket in np.flatnonzero(np.diff(found.bounds)).tolist():
        pairs, starts = found.part(bucket)
        totals, levels = answers[bucket]
        level[pairs] = np.frombuffer(levels, "<u2")
        known[found.contexts[pairs[starts]]] = _wide(totals)
    for number, value in enumerate(found.hashes.tolist()):
        known[number] = hot.get(value, known[number])
    known[1] = ends
    base = (known + 0.1) / (total + 0.1 * (distinct + 1))
    own = base[found.token_word]
    full = restored(level)[found.token_pair] + MU / (known[found.token_context] + MU) * own
    starts = found.offsets[:-1]
    n = len(starts)
    sums = lambda values: np.add.reduceat(values, starts) if n else np.zeros(0)
    return pa.table(
        [
            table["id"],
            table["held_out"],
            pa.array(np.diff(found.offsets), pa.int64()),
            pa.array(sums((known[found.token_word] > 0).astype(np.int64)), pa.int64()),
            pa.array(np.full(n, total), pa.int64()),
            pa.array(sums(np.log10(own)), pa.float64()),
            pa.array(sums(np.log10(full)), pa.float64()),
        ],
        ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )
