"""Token counts per section, from one encoding of the whole document.

A document is encoded whole, as a model would read it. Byte-level tokens follow each other without gaps, so the
character span of each token comes from the lengths of the tokens before it. Token spans are interval-joined to
the sections: both are sorted, and two binary searches give the sections that a token touches.

Allocation rule: a token belongs to the section with most of its characters; of equal shares the section that
begins first has it. A token that touches no section is counted under the null section. So the counts of a
document always sum to its tokens.

Defined results: a null or empty text has one empty section without tokens if lines are the sections, and no row
if sections are given but there are none. Sections may be empty, overlap or reach beyond the text; a null section
is passed over. Rows are never merged: a repeated row gives its sections again, and ``at`` (place in the scan) tells
them apart. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ROWS_OUT = 20_000


def encoding(ranks_path: str, pattern: str):
    """Byte-level encoding from a file of ranks; special tokens are ordinary text."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def spans(content: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of consecutive tokens with these byte lengths.

    A token with part of a character's bytes spans the whole character.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    if content.isascii():
        return starts, ends
    begins = (np.frombuffer(content, np.uint8) & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(begins)])
    return before[starts] - ~begins[starts], before[ends]


def allocate(starts: np.ndarray, ends: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token (-1: none), and whether it touches others too or reaches outside. Sections are sorted by begin."""
    if not len(begin):
        return np.full(len(starts), -1), np.zeros(len(starts), bool)
    reach = np.maximum.accumulate(end)
    first = np.searchsorted(reach, starts, "right")
    last = np.searchsorted(begin, ends, "left")
    near = np.minimum(first, len(begin) - 1)
    share = np.minimum(ends, end[near]) - np.maximum(starts, begin[near])
    out = np.where((last > first) & (share > 0), near, -1)
    crossing = (out >= 0) & (share < ends - starts)
    for token in np.flatnonzero(last - first > 1):
        over = slice(first[token], last[token])
        shares = np.minimum(ends[token], end[over]) - np.maximum(starts[token], begin[over])
        best = int(np.argmax(shares))
        out[token] = first[token] + best if shares[best] > 0 else -1
        crossing[token] = (shares > 0).sum() > 1 or 0 < shares[best] < ends[token] - starts[token]
    return out, crossing


def _lines(text: str) -> list[tuple[str, int, int]]:
    """Lines with their line breaks, numbered from 0."""
    at, out = 0, []
    for line in text.split("\n"):
        out.append((str(len(out)), at, at + len(line) + 1))
        at += len(line) + 1
    return [*out[:-1], (out[-1][0], out[-1][1], len(text))]


def joined_fields(docs: DataFrame, fields: Sequence[str], separator: str = "\n") -> DataFrame:
    """All columns, the fields as one ``text``, and ``sections`` with the span of each field; null fields are empty."""
    values = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields]
    at, sections = F.lit(0), []
    for name, value in zip(fields, values, strict=True):
        sections.append(F.struct(F.lit(name).alias("section"), at.alias("begin"), (at + F.char_length(value)).alias("end")))
        at = at + F.char_length(value) + len(separator)
    return docs.select("*", F.concat_ws(separator, *values).alias("text"), F.array(*sections).alias("sections"))


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text: str = "text", sections: str | None = None) -> DataFrame:
    """Per section: ``at``, id, ``section``, ``begin``, ``end``, ``n_tokens``, ``n_crossing`` (those that reach beyond it).

    ``sections`` names a column of arrays of (section, begin, end), in characters; without one, lines are sections.
    """
    key = docs.schema[id_col].dataType.simpleString()
    given = [F.col(f"`{sections}`").cast("array<struct<section: string, begin: int, end: int>>").alias("sections")] if sections else []
    rows = docs.select(F.monotonically_increasing_id().alias("at"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), *given)

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks_path, pattern)
        length = np.array([len(coder.decode_single_token_bytes(i)) for i in range(coder.max_token_value + 1)])
        for batch in batches:
            held = [[] for _ in range(7)]
            places, keys = batch.column(0).to_pylist(), batch.column(1)
            for row, value in enumerate(batch.column(2).to_pylist()):
                content = value or ""
                parts = [(s["section"], s["begin"] or 0, s["end"] or 0) for s in batch.column(3)[row].as_py() or () if s] if sections else _lines(content)
                parts.sort(key=lambda p: (p[1], p[2]))
                begin, end = np.array([p[1] for p in parts], int), np.array([p[2] for p in parts], int)
                ids = np.array(coder.encode_ordinary(content), int)
                own, crossing = allocate(*spans(content.encode("utf-8", "replace"), length[ids]), begin, end)
                counts = np.bincount(own + 1, minlength=len(parts) + 1)
                crossed = np.bincount(own[crossing] + 1, minlength=len(parts) + 1)
                found = [(None, None, None)] if counts[0] else []
                keep = slice(0 if counts[0] else 1, None)
                for column, values in zip(held, ([places[row]] * (len(found) + len(parts)), [row] * (len(found) + len(parts)), *([p[i] for p in (*found, *parts)] for i in range(3)), counts[keep], crossed[keep]), strict=True):
                    column.extend(values)
                if len(held[0]) >= ROWS_OUT:
                    yield _out(held, keys)
                    held = [[] for _ in range(7)]
            if held[0]:
                yield _out(held, keys)

    schema = f"at long, `{id_col}` {key}, section string, begin int, end int, n_tokens long, n_crossing long"
    return rows.mapInArrow(attribute, schema.replace(f"`{id_col}`", "id")).withColumnRenamed("id", id_col)


def _out(held: list[list], keys: pa.Array) -> pa.RecordBatch:
    kinds = (pa.int64(), None, pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    columns = [keys.take(pa.array(c, pa.int64())) if k is None else pa.array(c, k) for c, k in zip(held, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["at", "id", "section", "begin", "end", "n_tokens", "n_crossing"])
