"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space, which no token of the tokenizer crosses. A scan task gathers rows to
chunks and sends each distinct word of a chunk, once, to the bucket of that word. The bucket encodes every
distinct word a single time (once per task, where a cluster has more tasks than buckets) and answers each chunk with ids in the order the words were sent, so neither
words nor positions travel back. The chunk then puts the ids to the places of its words. The texts are
shuffled once, compressed. Decoding joins ids to the table of pieces, which is as large as the vocabulary.

Defined results: a null or blank text has no ids and decodes to the empty text. Null ids and repeated rows
are kept as they are, one result row per input row. An empty table gives no rows. Extra columns are ignored
unless named in ``keep``, whatever they are called.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tierloom.llm.shared import chunks, in_file_order, pack_chunks, unpacked

# Buckets that words are dealt to, and so the most rows a chunk sends; it depends neither on the data nor on the cluster.
BUCKETS = 256
# Words a bucket task remembers; beyond it the memory is emptied and a word may be encoded again.
REMEMBERED = 500_000
TEXT = "_text"


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _sent_words(values: Sequence[bytes | None], buckets: int) -> list[list[bytes]]:
    """Distinct words of a chunk, each in its bucket, in order of first appearance."""
    seen: dict[bytes, None] = {}
    for value in values:
        if value:
            seen.update(dict.fromkeys(value.split()))
    dealt: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in seen:
        dealt[crc32(word) % buckets].append(word)
    return dealt


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    ids: bool = True,
    digests: bool = False,
) -> DataFrame:
    """The ``keep`` columns and ``ids`` (array of int) of every row.

    Ids are those the tokenizer gives for the whole text without added special tokens. ``digests`` adds the number
    of ids and SHA-256 of the ids (little-endian, 32 bits each) and of the text decoded from them; they are taken
    where the ids are, so that with ``ids`` off those need not leave the task.
    """
    table_of_pieces = _pieces_table(tokenizer_path) if digests else None
    # With more tasks than buckets the chunks are dealt to several tasks of a bucket, each of which encodes a word once.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.pmod(F.xxhash64("chunk"), F.lit(max(1, tasks // BUCKETS)))
    buckets = BUCKETS
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = in_file_order(docs.select(*kept, F.col(f"`{text}`").cast("binary").alias(TEXT)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table in chunks(batches, TEXT):
            dealt = [(b, b"\n".join(w)) for b, w in enumerate(_sent_words(table[TEXT].to_pylist(), buckets)) if w]
            for start in range(0, len(dealt), 256):
                part = dealt[start : start + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in part], pa.int32()), pa.array([name] * len(part), pa.binary()), pa.array([w for _, w in part], pa.binary())],
                    ["bucket", "chunk", "words"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        known: dict[bytes, bytes] = {}
        for batch in batches:
            for bucket, name, sent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = sent.split(b"\n")
                if len(known) > REMEMBERED:
                    known.clear()
                new = [w for w in words if w not in known]
                coded = tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in new], add_special_tokens=False)
                known.update((w, np.array(c.ids, "<u4").tobytes()) for w, c in zip(new, coded, strict=True))
                found = [known[w] for w in words]
                lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([name], pa.binary()), pa.array([_narrow(lengths)], pa.binary()), pa.array([_narrow(np.frombuffer(b"".join(found), "<u4"))], pa.binary())],
                    ["bucket", "chunk", "lengths", "ids"],
                )

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = dict(zip(right["bucket"].to_pylist(), zip(right["lengths"].to_pylist(), right["ids"].to_pylist(), strict=True), strict=True))
        out = []
        for value in left["rows"].to_pylist():
            table = unpacked(value)
            out.append(_place(table, answers, buckets, schema, table_of_pieces))
        return pa.concat_tables(out) if out else schema.empty_table()

    answered = (
        rows.mapInArrow(send, "bucket int, chunk binary, words binary")
        .repartition(tasks, "bucket", group)
        .mapInArrow(answer, "bucket int, chunk binary, lengths binary, ids binary")
    )
    fields = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] if ids else []
    if digests:
        added += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    spark_schema = T.StructType([*fields, *added])
    schema = to_arrow_schema(spark_schema)
    joined = pack_chunks(rows, TEXT).groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(place, spark_schema)
    return joined.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[f.name for f in added])


def _narrow(values: np.ndarray) -> bytes:
    """A width byte, then the numbers in as few bytes each."""
    width = 1 if not values.size or values.max() < 256 else 2 if values.max() < 65_536 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _wide(value: bytes) -> np.ndarray:
    return np.frombuffer(value, f"<u{value[0]}", offset=1)


def _place(table: pa.Table, answers: dict, buckets: int, schema: pa.Schema, table_of_pieces: np.ndarray | None) -> pa.Table:
    """Ids of the rows of one chunk: the ids of each word, at the places the word has."""
    texts = table[TEXT].to_pylist()
    number: dict[bytes, int] = {}
    lengths, ids = [], []
    for bucket, words in enumerate(_sent_words(texts, buckets)):
        if words:
            got = _wide(answers[bucket][0])
            if len(got) != len(words):
                raise RuntimeError("the input changed between two passes; store it first")
            number.update(zip(words, range(len(number), len(number) + len(words)), strict=True))
            lengths.append(got.astype(np.int64))
            ids.append(_wide(answers[bucket][1]).astype(np.int32))
    length = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
    coded = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    start = np.cumsum(length) - length
    out: dict[str, list] = {n: [] for n in schema.names if n not in table.column_names}
    flat, sizes = [], []
    for text in texts:
        words = text.split() if text else ()
        at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        n = length[at]
        total = int(n.sum())
        values = coded[np.repeat(start[at] - (np.cumsum(n) - n), n) + np.arange(total)]
        if "ids" in out:
            flat.append(values)
            sizes.append(total)
        if table_of_pieces is not None:
            out["n_tokens"].append(total)
            out["ids_sha256"].append(hashlib.sha256(values.astype("<u4").tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(_decoded(values, table_of_pieces)).hexdigest())
    columns = [table.column(c) if c in table.column_names else pa.array(out[c]) for c in schema.names if c != "ids"]
    if "ids" in out:
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *flat])))
        columns.insert(schema.get_field_index("ids"), lists)
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pieces(tokenizer_path: str) -> list[str]:
    """Piece of every id; ids that the vocabulary skips have none."""
    vocabulary = _tokenizer(tokenizer_path).get_vocab(with_added_tokens=True)
    out = [""] * (max(vocabulary.values(), default=-1) + 1)
    for piece, number in vocabulary.items():
        out[number] = piece
    return out


def _pieces_table(tokenizer_path: str) -> np.ndarray:
    """Pieces by id, as bytes; only for tokenizers that join their pieces with spaces."""
    if _tokenizer(tokenizer_path).decoder is not None:
        raise ValueError("only tokenizers that join their pieces with spaces are supported")
    return np.array([p.encode() if p else None for p in pieces(tokenizer_path)], object)


def _decoded(ids: np.ndarray, table: np.ndarray) -> bytes:
    """Join of ids to pieces, which are looked up by place; ids without a piece are passed over."""
    found = table[ids].tolist()
    return b" ".join(found if None not in found else [p for p in found if p is not None])


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the decoded text: ids joined to their pieces, with one space between pieces.

    That is what a tokenizer without a decoder of its own gives, special tokens included; another kind is
    refused. Ids without a piece are passed over, as the library does.
    """
    table = _pieces_table(tokenizer_path)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(batch.schema.get_field_index(ids)):
                values = value.values
                texts.append(b"" if values is None else _decoded(values.to_numpy(zero_copy_only=False), table))
            column = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])

    return encoded.mapInArrow(join, T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())]))


def encoded_digests(docs: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, number of tokens, digests of the ids and of the text decoded from them."""
    return encode(docs, tokenizer_path, text, (id_col,), ids=False, digests=True)
