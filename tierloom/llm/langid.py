"""Language identification by nearest centroids of n-gram vectors.

A text becomes counts of its letter n-grams (1 to 3 letters, lower-cased, anything but letters as one space),
hashed to ``DIMENSIONS`` places, weighted by TF-IDF and normalised. The labelled rows of each language are
clustered to a few centroids by spherical k-means; a text takes the language of the centroid with the largest
cosine. A text farther from every centroid than the threshold for its length is rejected.

The centroids are fitted on a bounded sample of the labelled rows: ``PER_LANGUAGE`` rows of each language, at most
``SAMPLE`` in all, chosen by a hash. Inverse document frequencies and thresholds come from all labelled rows, one
pass each that sums counts per task: a threshold is ``MARGIN`` times the ``QUANTILE`` of the cosines of learned
texts, and of an excerpt of each, with about as many different n-grams. Prediction reads whole texts and is one
pass without a shuffle.

Defined results: a null text or one without a letter is ``und`` with score 0, and rejected; so is every text
if there is nothing to learn from. Equal cosines go to the first language in code point order. A row without an
id is never learned from. Repeated rows get equal answers; extra columns are kept by ``keep_identified`` and
ignored by ``predict``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tierloom.llm.shared import is_held_out, learned_from

DIMENSIONS = 8192
CENTROIDS = 4
PER_LANGUAGE, SAMPLE = 300, 3000
FOLDS = 5
# The bound on hashes leaves this many times the rows that are wanted, on average.
SPARE = 3
UNDETERMINED = "und"
# Characters looked at together, to bound the memory that a long text takes.
PIECE = 1_000_000
# Thresholds: each learned text adds an excerpt of one of these numbers of words, chosen by its id.
EXCERPT_WORDS = (1, 2, 4, 8, 16, 32)
# The quantile of cosines a threshold lies below, by which factor, and the cosines that it needs at least.
QUANTILE, MARGIN, LEAST = 0.01, 0.7, 100
# Lengths are powers of two of different n-grams, cosines are counted in steps.
LENGTHS, STEPS = DIMENSIONS.bit_length(), 1000
LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str, is_letter: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts of a whole text; pieces are counted one by one, with the end of the one before in front."""
    out = np.zeros(DIMENSIONS, np.float64)
    whole, before = " " + text.lower() + " ", np.zeros(0, np.uint32)
    for start in range(0, len(whole), PIECE):
        codes = np.frombuffer(whole[start : start + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        codes[~is_letter[codes]] = 32
        codes = np.concatenate([before, codes])
        space = codes == 32
        codes = codes[~(space & np.concatenate([[False], space[:-1]]))]
        done, before = len(before), codes[1 - len(_MULTIPLIERS) :]
        codes = codes.astype(np.uint64)
        gram = np.zeros(len(codes), np.uint64)
        for n, multiplier in enumerate(_MULTIPLIERS):
            if len(codes) <= n:
                break
            gram = gram[: len(codes) - n] * np.uint64(0x100000001B3) + codes[n:] + np.uint64(n + 1)
            # Those that end in the piece before are counted already.
            kept = gram[max(done - n, 0) :] if n else gram[done:][codes[done:] != 32]
            out += np.bincount(((kept * np.uint64(multiplier)) >> np.uint64(51)).astype(np.int64), minlength=DIMENSIONS)
    return out


def length(grams: np.ndarray) -> int:
    """Binary logarithm of the number of different n-grams: repeated words make a text no longer."""
    return int(np.count_nonzero(grams)).bit_length() - 1


@dataclass(frozen=True)
class Classifier:
    """What prediction needs: weights of the places, unit centroids with their languages, and a threshold per length."""

    languages: tuple[str, ...]
    weights: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    thresholds: np.ndarray

    def vector(self, grams: np.ndarray) -> np.ndarray:
        weighted = np.log1p(grams) * self.weights
        return weighted / (np.linalg.norm(weighted) or 1.0)

    def predict(self, text: str | None, is_letter: np.ndarray) -> tuple[str, float, bool]:
        """Language, cosine, and whether the text is rejected."""
        if not text or not self.languages or not LETTER.search(text):
            return UNDETERMINED, 0.0, True
        grams = counts(text, is_letter)
        if not grams.any():
            return UNDETERMINED, 0.0, True
        best, score = self.nearest(grams)
        return self.languages[self.of[best]], score, score < self.thresholds[length(grams)]

    def nearest(self, grams: np.ndarray) -> tuple[int, float]:
        """The centroid with the largest cosine, and that cosine."""
        cosines = self.centroids @ self.vector(grams)
        best = int(np.argmax(cosines))
        return best, float(min(1.0, max(0.0, cosines[best])))


def clustered(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to ``k`` unit centroids by spherical k-means, started from vectors far from each other."""
    chosen = [0]
    while len(chosen) < min(k, len(vectors)):
        near = (vectors @ vectors[chosen].T).max(axis=1)
        if near.min() > 1 - 1e-9:
            break
        chosen.append(int(np.argmin(near)))
    centroids = vectors[chosen]
    for _ in range(rounds):
        member = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[member == c].sum(axis=0) if (member == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def labelled(docs: DataFrame, id_col: str, text: str, lang: str) -> DataFrame:
    """Rows to learn from: those with a label and an id, outside the held-out fold."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    return rows.where(F.col("lang").isNotNull() & learned_from(F.col("id"), FOLDS))


def sample(docs: DataFrame, id_col: str, text: str, lang: str) -> DataFrame:
    """Labelled rows to fit centroids on: ids are chosen from the narrow columns, then only their texts are read."""
    rows = labelled(docs, id_col, text, lang)
    # Of a language the rows with the least hashes are wanted. A bound on the hash, from the number of its rows, leaves a
    # few more than that, so no task gets a whole language.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = F.broadcast(sizes) if sizes.count() <= SAMPLE else sizes
    unit = (F.xxhash64("id").cast("double") / 2.0**64) + 0.5
    near = rows.select("id", "lang").join(sizes, "lang").where(unit * F.col("n") <= SPARE * PER_LANGUAGE).select("id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    first = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PER_LANGUAGE)
    ids = [r[0] for r in first.select("id", "place", "lang").distinct().orderBy("place", "lang").limit(SAMPLE).select("id").collect()]
    return rows.where(F.col("id").isin(ids) & F.col("text").isNotNull())


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Classifier:
    """Classifier from the labelled rows outside the held-out fold; at most ``SAMPLE`` vectors reach the driver."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in batches:
            rows = [
                (str(key), language, sparse(counts(value, is_letter)))
                for key, language, value in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                if LETTER.search(value)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 3, (pa.string(), pa.string(), pa.binary()), strict=True)], ["id", "lang", "whole"])

    found = sample(docs, id_col, text, lang).mapInArrow(vectors, "id string, lang string, whole binary")
    # An id that many rows share gives one of them.
    one = found.groupBy("id").agg(F.min(F.struct("lang", "whole")).alias("one")).select("one.*").orderBy("lang", "whole").collect()
    if not one:
        return Classifier((), np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)), np.zeros(0, int), np.zeros(LENGTHS))
    learned = labelled(docs, id_col, text, lang).select("id", "text")
    classifier = fitted([tuple(r) for r in one], frequencies(learned))
    return replace(classifier, thresholds=thresholds(cosine_counts(learned, classifier)))


def summed(learned: DataFrame, tally: Callable[[str, str, np.ndarray], Iterable[np.ndarray]], places: int) -> np.ndarray:
    """How often all texts with a letter hit each place; ``tally`` gives the places of a text, a task adds them up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, total = letters(), np.zeros(places, np.int64)
        for batch in batches:
            for key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if value and LETTER.search(value):
                    for hit in tally(str(key), value, is_letter):
                        total[hit] += 1
        hits = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hits, pa.int32()), pa.array(total[hits], pa.int64())], ["place", "n"])

    out = np.zeros(places, np.int64)
    for place, n in learned.mapInArrow(add, "place int, n long").groupBy("place").agg(F.sum("n")).collect():
        out[place] = n
    return out


def frequencies(learned: DataFrame) -> np.ndarray:
    """Texts that hold an n-gram of each place; the number of texts is last."""

    def tally(key: str, text: str, is_letter: np.ndarray) -> list[np.ndarray]:
        return [np.append(np.flatnonzero(counts(text, is_letter)), DIMENSIONS)]

    return summed(learned, tally, DIMENSIONS + 1)


def cosine_counts(learned: DataFrame, classifier: Classifier) -> np.ndarray:
    """Learned texts and their excerpts per length and step of the best cosine."""

    def tally(key: str, text: str, is_letter: np.ndarray) -> Iterator[np.ndarray]:
        words = text.split()
        many = EXCERPT_WORDS[zlib.crc32(key.encode()) // FOLDS % len(EXCERPT_WORDS)]
        for part in (text, " ".join(words[len(words) // 2 :][:many])):
            grams = counts(part, is_letter)
            if grams.any():
                yield np.array([length(grams) * (STEPS + 1) + int(classifier.nearest(grams)[1] * STEPS)])

    return summed(learned, tally, LENGTHS * (STEPS + 1)).reshape(LENGTHS, STEPS + 1)


def thresholds(counted: np.ndarray) -> np.ndarray:
    """Threshold per length, from the cosines of that length and its neighbours, the least quantile of them.

    Neighbours are taken in until there are ``LEAST`` cosines. Texts shorter than all that were learned stay.
    """
    have = counted.sum(axis=1)
    lengths = np.flatnonzero(have)
    quantiles = {at: int(np.searchsorted(np.cumsum(counted[at]), max(1, QUANTILE * have[at]))) / STEPS for at in lengths}
    out = np.zeros(LENGTHS)
    for at in range(lengths[0] if len(lengths) else LENGTHS, LENGTHS):
        reach = next((r for r in range(1, LENGTHS) if have[max(0, at - r) : at + r + 1].sum() >= LEAST), LENGTHS)
        out[at] = MARGIN * min(q for near, q in quantiles.items() if abs(near - at) <= reach)
    return out


def sparse(grams: np.ndarray) -> bytes:
    """Places and counts of the n-grams that occur, as pairs of 32-bit numbers."""
    places = np.flatnonzero(grams)
    return np.stack([places, np.minimum(grams[places], 2**32 - 1)], axis=1).astype("<u4").tobytes()


def dense(values: list[bytes]) -> np.ndarray:
    """One row of counts per value."""
    out = np.zeros((len(values), DIMENSIONS), np.float32)
    for row, value in zip(out, values, strict=True):
        places, counted = np.frombuffer(value, "<u4").reshape(-1, 2).T
        row[places] = counted
    return out


def fitted(rows: list[tuple[str, bytes]], found_in: np.ndarray) -> Classifier:
    """Classifier without thresholds from (language, sparse counts of a text) and the frequencies of all texts."""
    languages = tuple(sorted({r[0] for r in rows}))
    grams = dense([r[1] for r in rows])
    weights = (np.log((1 + found_in[-1]) / (1 + found_in[:-1])) + 1).astype(np.float32)
    vectors = (v := np.log1p(grams) * weights) / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    del grams, v
    named = np.array([languages.index(r[0]) for r in rows])
    sets = [clustered(vectors[named == i], CENTROIDS) for i in range(len(languages))]
    centroids, of = np.concatenate(sets), np.repeat(np.arange(len(languages)), [len(s) for s in sets])
    return Classifier(languages, weights.astype(np.float64), centroids.astype(np.float64), of, np.zeros(LENGTHS))


def predict(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``; reads nothing but id and text."""
    key = docs.schema[id_col]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in batches:
            rows = [classifier.predict(value, is_letter) for value in batch.column(1).to_pylist()]
            named, scores, rejected = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(named, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [id_col, "lang_pred", "score", "rejected"],
            )

    schema = f"`{id_col}` {key.dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return docs.select(id_col, text).mapInArrow(answer, schema)


def identified(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Fit, then predict every row; ``held_out`` marks rows of the fold that is not learned from."""
    found = predict(docs, fit(docs, id_col, text, lang), id_col, text)
    return found.withColumn("held_out", is_held_out(F.col(id_col), FOLDS))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose language is recognised, all columns kept as they are."""
    classifier = fit(docs, id_col, text, lang)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in batches:
            stays = [not classifier.predict(value, is_letter)[2] for value in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
