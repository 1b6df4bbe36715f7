"""Alignment of two tokenizers, and how often their tokens meet.

A text, with a space before it, is cut into tokens by a byte-level tokenizer (A) and by a piece tokenizer (B). Tokens
are placed by their bytes: two tokens are linked where their bytes overlap, and the places where a token of each ends
cut both sequences into groups. An id pair's count is the number of documents that hold it linked.

First pass: a scan task gathers rows to chunks, aligns them, and writes for each chunk its packed rows and, per shard
of A ids, its distinct pairs with their document counts. The pairs of a shard are united in a tree of tasks; a
minimal perfect hash gives each an index, and the pair itself is kept there to verify lookups. The chunks' counts
become dense vectors by these indices, which a tree of tasks sums. Second pass: each chunk's pairs are looked up,
and the chunk aligns its rows again and adds up the counts. Every group of a shard holds at most ``FAN_IN`` rows, and
a shard at most 1 / ``SHARDS`` of the pairs that the two vocabularies allow, however many documents there are.

Where no token of the vocabularies has a space behind another character, texts are cut at the spaces between words and
every distinct piece of a chunk is encoded once. Otherwise, and where a piece's tokens do not give its bytes, texts
are encoded whole.

Defined results: texts that are null, empty, no valid UTF-8, or whose A or B tokens do not join to the bytes of the
text have no tokens: all numbers are 0 and the digest is empty. Repeated rows are documents of their own. Strings of
special tokens are plain text. An empty table gives no rows. Extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tierloom.llm.perfect_hash import PerfectHash
from tierloom.llm.shared import chunks, packed, store, unpacked

SHARDS = 128
FAN_IN = 256
# Bytes of text that one chunk gathers; a longer text is a chunk of its own.
CHUNK_BYTES = 6_000_000
# Rows are counted in blocks of about so many pieces.
BLOCK = 200_000
TEXT = "_text"
SPACE_MARK = "▁"
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
# Texts with a space at an end or beside other white space; all others can be split at every space.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
ODD_SPACES = f"^ | $|{_WHITE} | {_WHITE}"
# Pieces of characters that every version of the Unicode tables treats alike, without white space at their ends.
PLAIN = re.compile("[^\\s\u0300-\U0010ffff](?:[^\u0300-\U0010ffff]*[^\\s\u0300-\U0010ffff])?")
# Fixed value: the pattern byte-level tokenizers split text with before they merge.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNKS = "chunk binary, rows binary, shard int, pairs array<bigint>, counts array<bigint>"


def byte_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write it with: printable ones as they are, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _expanded(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Numbers from each start on, as many as its count."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


@dataclass(frozen=True)
class Tokens:
    """Tokens of both tokenizers for a list of pieces: all ids, and how many each piece has."""

    a: np.ndarray
    a_count: np.ndarray
    b: np.ndarray
    b_count: np.ndarray

    def take(self, pieces: np.ndarray) -> Tokens:
        sides = []
        for ids, count in ((self.a, self.a_count), (self.b, self.b_count)):
            starts = np.cumsum(count) - count
            sides += [ids[_expanded(starts[pieces], count[pieces])], count[pieces]]
        return Tokens(*sides)

    def and_then(self, other: Tokens) -> Tokens:
        return Tokens(*[np.concatenate([getattr(t, name) for t in (self, other)]) for name in ("a", "a_count", "b", "b_count")])


class Coder:
    """Both tokenizers, and the bytes of all their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = np.full(max(entries.values()) + 1, b"", object)
        for entry, number in entries.items():
            self.a_bytes[number] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.b_size = self.b.get_piece_size()
        names = self.b.id_to_piece(list(range(self.b_size)))
        self.b_bytes = np.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(names)], object)
        self.a_length, self.b_length = (np.array([len(v) for v in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # A token with a space behind a character that is no white space could join two words.
        self.in_words = not any(re.search(r"\S ", v.decode(errors="replace")) for t in (self.a_bytes, self.b_bytes) for v in t)
        self.ranked = self._ranked(a_path)

    def _ranked(self, a_path: str):
        """The byte-level tokenizer as a table of ranks, if its merges stand in the order of the ids they make."""
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            given = json.load(file)
        model, before = given["model"], given.get("pre_tokenizer") or {}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        made = [model["vocab"].get(x + y, -1) for x, y in pairs]
        usual = (
            given.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        )
        if not usual or not self.in_words or made != sorted(set(made)) or len(model["vocab"]) != len(made) + 256:
            return None
        ranks = {self.a_bytes[n]: n for n in model["vocab"].values()}
        return tiktoken.Encoding("ranked", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def pieces(self, texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct parts of texts that are encoded on their own, each without the space before it.

        Also the numbers of the parts of all texts in order, and how many each text has.
        """
        column = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, ODD_SPACES).to_numpy(zero_copy_only=False) if self.in_words else np.ones(len(texts), bool)
        full = np.array([bool(t) for t in texts], bool)
        even = full & ~odd
        apart = [BETWEEN_WORDS.split(texts[i]) if self.in_words else [texts[i]] for i in np.flatnonzero(full & odd)]
        split = pc.split_pattern(column.filter(pa.array(even)), " ")
        flat = pa.concat_arrays([split.flatten(), pa.array(list(chain.from_iterable(apart)), pa.string())]).dictionary_encode()
        counts = np.zeros(len(texts), np.int64)
        counts[even] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        counts[full & odd] = [len(p) for p in apart]
        order = np.concatenate([np.flatnonzero(even), np.flatnonzero(full & odd)])
        starts = np.zeros(len(texts), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        numbers = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return flat.dictionary.to_pylist(), numbers[_expanded(starts, counts)], counts

    def tokens(self, pieces: Sequence[str]) -> tuple[Tokens, np.ndarray]:
        """Tokens of each piece with a space before it, and which pieces' tokens do not give their bytes."""
        content = [b" " + p.encode() for p in pieces]
        size = np.array([len(c) for c in content], np.int64)
        b_count, parts = np.zeros(len(pieces), np.int64), []
        for start in range(0, len(pieces), 20_000):
            found = self.b.encode(pieces[start : start + 20_000], num_threads=1)
            b_count[start : start + len(found)] = [len(f) for f in found]
            parts.append(np.fromiter(chain.from_iterable(found), np.int64))
        b = np.concatenate([np.zeros(0, np.int64), *parts])
        a, a_count = self._a_tokens(pieces, size)
        lost = np.zeros(len(pieces), bool)
        whole = b"".join(content)
        for ids, count, table, length in ((a, a_count, self.a_bytes, self.a_length), (b, b_count, self.b_bytes, self.b_length)):
            ends = np.cumsum(count)
            upto = np.concatenate([[0], np.cumsum(length[ids])])
            lost |= upto[ends] - upto[ends - count] != size
            written = table[ids].tolist()
            if lost.any() or b"".join(written) != whole:
                lost |= np.array([b"".join(written[e - n : e]) != c for e, n, c in zip(ends.tolist(), count.tolist(), content, strict=True)], bool)
        return Tokens(a, a_count, b, b_count), lost

    def _a_tokens(self, pieces: Sequence[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = np.array([self.ranked is not None and PLAIN.fullmatch(p) is not None for p in pieces], bool)
        counts, parts = np.zeros(len(pieces), np.int64), []
        if plain.any():
            ids = self.ranked.encode_to_numpy(" " + " ".join(compress(pieces, plain)), disallowed_special=()).astype(np.int64)
            ends = np.cumsum(size[plain])
            counts[plain] = np.bincount(np.searchsorted(ends, np.cumsum(self.a_length[ids])), minlength=len(ends))
            parts.append(ids)
        others = np.flatnonzero(~plain)
        for start in range(0, len(others), 5_000):
            some = others[start : start + 5_000]
            found = [e.ids for e in self.a.encode_batch([" " + pieces[i] for i in some], add_special_tokens=False)]
            counts[some] = [len(f) for f in found]
            parts.append(np.fromiter(chain.from_iterable(found), np.int64))
        order = np.concatenate([np.flatnonzero(plain), others])
        starts = np.zeros(len(pieces), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        flat = np.concatenate([np.zeros(0, np.int64), *parts])
        return flat[_expanded(starts, counts)], counts


@dataclass(frozen=True)
class Aligned:
    """Distinct pieces of a chunk: tokens, links and groups, each in the order of the pieces."""

    a: np.ndarray
    b: np.ndarray
    a_piece: np.ndarray
    b_piece: np.ndarray
    # Per token the number of its group, over all pieces; per group its piece.
    a_group: np.ndarray
    b_group: np.ndarray
    group_piece: np.ndarray
    # Per link its pair and its piece.
    pairs: np.ndarray
    link_piece: np.ndarray
    # Number of pieces.
    size: int


def align_pieces(code: Coder, tokens: Tokens) -> Aligned:
    """Alignment of pieces, given their tokens; the bytes of all pieces follow each other on both sides."""
    a, b, pieces = tokens.a, tokens.b, np.arange(len(tokens.a_count))
    a_piece, b_piece = np.repeat(pieces, tokens.a_count), np.repeat(pieces, tokens.b_count)
    a_end, b_end = np.cumsum(code.a_length[a]), np.cumsum(code.b_length[b])
    a_start, b_start = a_end - code.a_length[a], b_end - code.b_length[b]
    first, stop = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    links = stop - first
    of_a = np.repeat(np.arange(len(a)), links)
    of_b = _expanded(first, links)
    # A token of A ends a group where the last token of B it is linked to ends.
    closes = b_end[stop - 1] == a_end if len(a) else np.zeros(0, bool)
    a_group = np.cumsum(closes) - closes
    b_group = np.searchsorted(a_end[closes], b_end)
    return Aligned(a, b, a_piece, b_piece, a_group, b_group, a_piece[closes], a[of_a] * code.b_size + b[of_b], a_piece[of_a], len(pieces))


@dataclass(frozen=True)
class Chunk:
    """Rows of a chunk as numbers of pieces, how many each row has, and the alignment of the pieces."""

    numbers: np.ndarray
    counts: np.ndarray
    aligned: Aligned
    pairs: np.ndarray
    link_pair: np.ndarray


def _decoded(value: bytes | None) -> str:
    try:
        return value.decode() if value else ""
    except UnicodeDecodeError:
        return ""


def align_chunk(code: Coder, values: Sequence[bytes | None]) -> Chunk:
    """Pieces of every text. A text with a piece that cannot be placed is one piece; if that cannot be placed, it has none."""
    texts = [_decoded(v) for v in values]
    pieces, numbers, counts = code.pieces(texts)
    tokens, lost = code.tokens(pieces)
    if lost.any():
        row = np.repeat(np.arange(len(texts)), counts)
        broken = np.unique(row[lost[numbers]])
        whole, still_lost = code.tokens([texts[i] for i in broken])
        good = ~np.isin(row, broken)
        rows = np.concatenate([row[good], broken[~still_lost]])
        numbers = np.concatenate([numbers[good], len(pieces) + np.flatnonzero(~still_lost)])[np.argsort(rows, kind="stable")]
        counts = np.bincount(rows, minlength=len(texts))
        used, numbers = np.unique(numbers, return_inverse=True)
        tokens = tokens.and_then(whole).take(used)
    aligned = align_pieces(code, tokens)
    pairs, link_pair = np.unique(aligned.pairs, return_inverse=True)
    return Chunk(numbers, counts, aligned, pairs, link_pair)


def document_counts(chunk: Chunk) -> np.ndarray:
    """For each pair of the chunk, how many of its rows hold the pair linked."""
    pairs = len(chunk.pairs)
    total, seen = np.zeros(pairs, np.int64), np.zeros(pairs, bool)
    links = np.bincount(chunk.aligned.link_piece, minlength=chunk.aligned.size)
    starts = np.cumsum(links) - links
    ends = np.cumsum(chunk.counts)
    low = 0
    while low < len(ends):
        begin = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, begin + BLOCK)))
        pieces = chunk.numbers[begin : ends[high - 1]]
        held = chunk.link_pair[_expanded(starts[pieces], links[pieces])]
        stops = np.concatenate([[0], np.cumsum(links[pieces])])[ends[low:high] - begin]
        for start, stop in zip([0, *stops.tolist()], stops.tolist(), strict=False):
            found = held[start:stop]
            if len(found) * 8 < pairs:
                total[np.unique(found)] += 1
            else:
                seen[found] = True
                total += seen
                seen[found] = False
        low = high
    return total


def _by_shard(code: Coder, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards of sorted pairs with the places of their pairs; all pairs of an A id lie in one shard."""
    shard = pairs // code.b_size % SHARDS
    order = np.argsort(shard, kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=SHARDS))
    for s, end in enumerate(ends):
        begin = ends[s - 1] if s else 0
        if end > begin:
            yield s, order[begin:end]


def _numbers(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [v.values.to_numpy() for v in column]


def _lists(arrays: Sequence[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays]).astype(np.int64)))


def _read_chunks(docs: DataFrame, code: Callable[[], Coder], text: str, keep: Sequence[str]) -> DataFrame:
    """Written table of the first pass: one row per chunk with its packed rows, and one per chunk and shard with its pairs."""
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.col(f"`{text}`").cast("binary").alias(TEXT))
    schema = to_arrow_schema(T._parse_datatype_string(CHUNKS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table in chunks(batches, TEXT, CHUNK_BYTES):
            yield pa.RecordBatch.from_pylist([{"chunk": name, "rows": packed(table)}], schema=schema)
            found = align_chunk(code(), table[TEXT].to_pylist())
            counts = document_counts(found)
            dealt = list(_by_shard(code(), found.pairs))
            columns = [
                pa.array([name] * len(dealt), pa.binary()),
                pa.nulls(len(dealt), pa.binary()),
                pa.array([s for s, _ in dealt], pa.int32()),
                _lists([found.pairs[at] for _, at in dealt]).cast(schema.field("pairs").type),
                _lists([counts[at] for _, at in dealt]).cast(schema.field("counts").type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return store(rows.mapInArrow(read, CHUNKS), "aligned_chunks")


def _merged(rows: DataFrame, parts: int, schema: str, merge: Callable[[pa.Table], pa.Table], name: str) -> DataFrame:
    """One row per shard: groups of at most about ``FAN_IN`` rows are merged, then their results, until one is left."""
    while True:
        rows = store(rows.groupBy("shard", "part").applyInArrow(merge, schema), name)
        if parts == 1:
            return rows
        parts = -(-parts // FAN_IN)
        rows = rows.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts)).cast("int"))


def _shard_models(sent: DataFrame, parts: int, b_size: int) -> DataFrame:
    """Per shard: the perfect hash of its pairs, the pairs in its order, their counts, and which are best for their A id."""
    united = "shard int, part int, pairs array<bigint>"
    summed = "shard int, part int, counts array<bigint>"

    def unite(table: pa.Table) -> pa.Table:
        pairs = np.unique(np.concatenate(_numbers(table["pairs"])))
        return pa.table({"shard": table["shard"][:1], "part": table["part"][:1], "pairs": _lists([pairs])})

    def hash_pairs(table: pa.Table) -> pa.Table:
        pairs = _numbers(table["pairs"])[0]
        hashed = PerfectHash.of(pairs)
        ordered = np.zeros_like(pairs)
        ordered[hashed.index(pairs)] = pairs
        return pa.table({"shard": table["shard"], "sizes": _lists([np.array(hashed.sizes, np.int64)]), "bits": pa.array([hashed.packed], pa.binary()), "ordered": _lists([ordered])})

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return pa.table({"shard": pa.array([], pa.int32()), "part": pa.array([], pa.int32()), "counts": _lists([])})
        ordered, index = _lookup(right)
        vector = np.zeros(len(ordered), np.int64)
        for pairs, counts in zip(_numbers(left["pairs"]), _numbers(left["counts"]), strict=True):
            vector[index(pairs)] += counts
        return pa.table({"shard": left["shard"][:1], "part": left["part"][:1], "counts": _lists([vector])})

    def add(table: pa.Table) -> pa.Table:
        vectors = _numbers(table["counts"])
        total = np.zeros_like(vectors[0])
        for vector in vectors:
            total += vector
        return pa.table({"shard": table["shard"][:1], "part": table["part"][:1], "counts": _lists([total])})

    pairs = _merged(sent.select("shard", "part", "pairs"), parts, united, unite, "shard_pairs")
    hashed = store(pairs.groupBy("shard").applyInArrow(hash_pairs, "shard int, sizes array<bigint>, bits binary, ordered array<bigint>"), "shard_hashes")
    vectors = store(sent.groupBy("shard", "part").cogroup(_for_parts(hashed, parts).groupBy("shard", "part")).applyInArrow(count, summed), "shard_vectors")
    if parts > 1:
        upper = -(-parts // FAN_IN)
        vectors = _merged(vectors.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(upper)).cast("int")), upper, summed, add, "shard_sums")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        a, n = _numbers(left["ordered"])[0] // b_size, _numbers(right["counts"])[0]
        ids, at = np.unique(a, return_inverse=True)
        most = np.zeros(len(ids), np.int64)
        np.maximum.at(most, at, n)
        return left.append_column("counts", _lists([n])).append_column("best", _lists([(n == most[at]).astype(np.int64)]))

    model = "shard int, sizes array<bigint>, bits binary, ordered array<bigint>, counts array<bigint>, best array<bigint>"
    totals = vectors.select("shard", "counts").groupBy("shard")
    return store(hashed.groupBy("shard").cogroup(totals).applyInArrow(best, model), "shard_models")


def _for_parts(models: DataFrame, parts: int) -> DataFrame:
    """Each shard's row for every part of the shard."""
    return models.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def _lookup(model: pa.Table) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Pairs of a shard by index, and a function from pairs to indices that verifies them."""
    hashed = PerfectHash(_numbers(model["sizes"])[0].tolist(), model["bits"][0].as_py())
    ordered = _numbers(model["ordered"])[0]

    def index(pairs: np.ndarray) -> np.ndarray:
        at = hashed.index(pairs)
        if len(at) and (at.min() < 0 or not np.array_equal(ordered[at], pairs)):
            raise RuntimeError("a pair is not in the hashed set")
        return at

    return ordered, index


def _first_pass(docs: DataFrame, code: Callable[[], Coder], b_size: int, text: str, keep: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Packed chunks, their pairs by shard and part, the models of the shards, and the number of parts."""
    written = _read_chunks(docs, code, text, keep)
    whole = written.where("rows is not null").select("chunk", "rows")
    parts = max(1, -(-whole.count() // FAN_IN))
    sent = written.where("shard is not null").select("chunk", "shard", "pairs", "counts", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int").alias("part"))
    return whole, sent, _shard_models(sent, parts, b_size), parts


def _loaders(a_path: str, b_path: str) -> tuple[Callable[[], Coder], int]:
    """What tasks load the tokenizers with, once for each task, and the size of the second vocabulary."""
    from sentencepiece import SentencePieceProcessor

    loaded: list[Coder] = []

    def code() -> Coder:
        if not loaded:
            loaded.append(Coder(a_path, b_path))
        return loaded[0]

    return code, SentencePieceProcessor(model_file=b_path).get_piece_size()


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Every linked id pair: ``a``, ``b``, ``documents`` that hold it, and whether that is ``best`` for its A id."""
    code, b_size = _loaders(a_path, b_path)
    models = _first_pass(docs, code, b_size, text, ())[2]
    entries = models.select(F.explode(F.arrays_zip("ordered", "counts", "best")).alias("e"))
    return entries.select(
        F.floor(F.col("e.ordered") / b_size).cast("int").alias("a"), (F.col("e.ordered") % b_size).cast("int").alias("b"), F.col("e.counts").alias("documents"), (F.col("e.best") == 1).alias("best")
    )


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), groups: bool = False) -> DataFrame:
    """The ``keep`` columns and, per row, numbers of tokens, groups and links, and what the pair counts say of the links.

    ``n_best``: links whose count is the highest of their A id, ties included. ``count_sum``: counts of all links.
    ``groups_sha256``: digest of the groups, which ``groups`` adds as text (``a1,a2|b1;a3|b2,b3``).
    """
    code, b_size = _loaders(a_path, b_path)
    whole, sent, models, parts = _first_pass(docs, code, b_size, text, keep)
    answered = "chunk binary, shard int, counts array<bigint>, best array<bigint>"
    sent_fields = to_arrow_schema(T._parse_datatype_string(answered))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return sent_fields.empty_table()
        _, index = _lookup(right)
        at = [index(p) for p in _numbers(left["pairs"])]
        counts, best = _numbers(right["counts"])[0], _numbers(right["best"])[0]
        columns = {"chunk": left["chunk"], "shard": left["shard"], "counts": _lists([counts[i] for i in at]), "best": _lists([best[i] for i in at])}
        return pa.table(columns).cast(sent_fields)

    answers = sent.groupBy("shard", "part").cogroup(_for_parts(models, parts).groupBy("shard", "part")).applyInArrow(answer, answered)
    fields = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    texts = ["groups_sha256", *(["groups"] if groups else [])]
    spark_schema = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in numbers], *[T.StructField(n, T.StringType()) for n in texts]])
    schema = to_arrow_schema(spark_schema)

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        given = {s: (c, b) for s, c, b in zip(right["shard"].to_pylist(), _numbers(right["counts"]), _numbers(right["best"]), strict=True)}
        out = []
        for value in left["rows"].to_pylist():
            table = unpacked(value)
            found = align_chunk(code(), table[TEXT].to_pylist())
            counts, best = np.zeros(len(found.pairs), np.int64), np.zeros(len(found.pairs), np.int64)
            for shard, at in _by_shard(code(), found.pairs):
                counts[at], best[at] = given[shard]
            sums = _row_sums(found, counts, best)
            digests, written = [], []
            for row in _row_groups(found):
                digests.append(hashlib.sha256(row.encode()).hexdigest() if row else "")
                if groups:
                    written.append(row)
            columns = [table.column(f"k{i}") for i in range(len(keep))]
            columns += [pa.array(s) for s in sums]
            columns.append(pa.array(digests, pa.string()))
            if groups:
                columns.append(pa.array(written, pa.string()))
            out.append(pa.table([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    joined = whole.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(place, spark_schema)
    return joined.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *numbers, *texts)


def _row_sums(chunk: Chunk, counts: np.ndarray, best: np.ndarray) -> list[np.ndarray]:
    """Per row: tokens of A and of B, groups, links, links that are best, and counts of all links."""
    found, pieces = chunk.aligned, chunk.aligned.size
    link_counts, link_best = counts[chunk.link_pair], best[chunk.link_pair]
    ends = np.searchsorted(found.link_piece, np.arange(pieces + 1))
    per_link = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[ends])
    per_piece = [np.bincount(p, minlength=pieces) for p in (found.a_piece, found.b_piece, found.group_piece, found.link_piece)]
    per_piece += [per_link(link_best), per_link(link_counts)]
    stops = np.concatenate([[0], np.cumsum(chunk.counts)])
    return [np.diff(np.concatenate([[0], np.cumsum(v[chunk.numbers])])[stops]).astype(np.int64) for v in per_piece]


def _row_groups(chunk: Chunk) -> Iterator[str]:
    """Groups of every row as text: each id is followed by the mark that says what comes next."""
    found, pieces = chunk.aligned, chunk.aligned.size
    ids = np.array([str(i) for i in range(max(found.a.max(initial=-1), found.b.max(initial=-1)) + 1)], object)
    last = lambda groups: np.diff(groups, append=-1) != 0
    ended = lambda tokens, groups, mark: np.where(last(groups), (ids + mark)[tokens], (ids + ",")[tokens])
    # Tokens of A come before those of B within their group.
    order = np.argsort(np.concatenate([found.a_group * 2, found.b_group * 2 + 1]), kind="stable")
    written = np.concatenate([ended(found.a, found.a_group, "|"), ended(found.b, found.b_group, ";")])[order].tolist()
    ends = np.cumsum(np.bincount(found.a_piece, minlength=pieces) + np.bincount(found.b_piece, minlength=pieces)).tolist()
    of_piece = np.array(["".join(written[start:end]) for start, end in zip([0, *ends], ends, strict=False)], object)
    stops = np.cumsum(chunk.counts).tolist()
    for start, stop in zip([0, *stops], stops, strict=False):
        yield "".join(of_piece[chunk.numbers[start:stop]].tolist())[:-1]
