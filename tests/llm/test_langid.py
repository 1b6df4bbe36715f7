"""Held-out accuracy, rejection and defined results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierloom.llm import langid
from tierloom.llm.shared import read


def test_held_out_accuracy(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = langid.identified(docs).where("held_out").join(docs, "doc_id")
    right, total, rejected = found.agg(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*"), F.sum(F.col("rejected").cast("int"))).first()
    assert total > 20 and right >= 0.95 * total and rejected == 0


@pytest.fixture(scope="module")
def classifier(spark, sf_dir):
    return langid.fit(read(spark, sf_dir, "documents"))


def test_defined_results(classifier, rows):
    docs = rows("doc_id long, text string, score string", (1, None, "x"), (1, "", "x"), (None, "12 !! \n", "x"), (4, "Привет мир как твои дела", "x"), (5, "the of and", "x"), (5, "the of and", "x"))
    found = sorted(((r["doc_id"] or 0, r["lang_pred"], r["rejected"]) for r in langid.predict(docs, classifier).collect()), key=str)
    assert [f for f in found if f[0] != 4] == [(0, "und", True), (1, "und", True), (1, "und", True), (5, "en", False), (5, "en", False)]
    assert next(f for f in found if f[0] == 4)[2]


def test_long_text_is_read_whole(classifier):
    is_letter = langid.letters()
    long = "der die das und ist nicht ein " * 60_000
    assert langid.counts(long, is_letter).sum() > 3_000_000
    assert classifier.predict("the of and to in " * 2 + long, is_letter)[0] == "de"


def test_nothing_to_learn_from(rows):
    docs = rows("doc_id long, text string, lang string", (None, "the of", "en"), (2, "the of", None), (3, None, "en"))
    assert {(r["lang_pred"], r["score"]) for r in langid.identified(docs).collect()} == {("und", 0.0)}
    assert langid.identified(docs.limit(0)).collect() == []


def test_prediction_ignores_lang_and_source(spark, sf_dir, classifier):
    docs = read(spark, sf_dir, "documents").limit(50)
    masked = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None)})
    assert sorted(langid.predict(docs, classifier).collect()) == sorted(langid.predict(masked, classifier).collect())


def test_keep_identified_keeps_columns(rows):
    docs = rows("doc_id long, text string, lang string, rejected int", *[(i, t, n, 7) for i, (t, n) in enumerate([("the of and that with this", "en"), ("der die das und nicht", "de")] * 20)], (99, None, "en", 7))
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 40


def test_clusters_start_apart():
    vectors = np.eye(5)[[0, 0, 1, 1, 2]]
    assert len(langid.clustered(vectors, 3)) == 3 and len(langid.clustered(vectors[:2], 4)) == 1


STRANGE = {
    "keyboard": "asdkjh qwoeiru zxmcnb lkjhasd qpwoei zmxncb alskdj fhgqwe rtyuio plmokn ijbuhv ygctfx rdzesw aqlkjh gfdsam nbvcxz",
    "keyboard, short": "asdkjh qwoeiru zxmcnb lkjhasd",
    "base64": "aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Qgb2YgYmFzZTY0IGVuY29kaW5nIHdpdGggc29tZSBsb25nZXIgdGV4dCBzbyB0aGF0IGl0IGlzIGxvbmcK",
    "Turkish": "Bugün hava çok güzel ve biz parkta yürüyüş yapmak istiyoruz çünkü uzun zamandır evde kaldık ve biraz temiz hava almak istiyoruz",
    "Polish": "Dzisiaj jest bardzo ładna pogoda i chcemy pójść na spacer do parku, ponieważ przez długi czas siedzieliśmy w domu",
    "Finnish": "Tänään on erittäin kaunis ilma ja haluamme mennä kävelylle puistoon, koska olemme olleet pitkään kotona",
}


@pytest.mark.parametrize("name", STRANGE)
@pytest.mark.parametrize("times", [1, 50])
def test_strange_text_in_latin_script_is_rejected(classifier, name, times):
    assert classifier.predict(f"{STRANGE[name]} " * times, langid.letters())[2]


def test_short_clean_text_stays(classifier):
    is_letter = langid.letters()
    assert not any(classifier.predict(t, is_letter)[2] for t in ("the", "the of and", "der die und", "que de los", "les des entre"))


def test_one_odd_learned_text_moves_no_threshold():
    counted = np.zeros((langid.LENGTHS, langid.STEPS + 1), np.int64)
    counted[8, 600] = 1000
    before = langid.thresholds(counted)
    counted[8, 10] = 1
    assert (langid.thresholds(counted) == before).all() and before[8] == pytest.approx(0.6 * langid.MARGIN)
    assert before[7] == 0 and before[13] == before[8]


def test_frequencies_count_every_learned_row(rows):
    docs = rows("id long, text string", *[(i, "the of") for i in range(700)], (701, None), (702, "12"))
    found = langid.frequencies(docs)
    assert found[-1] == 700 and set(found.tolist()) == {0, 700}


def test_pieces_of_a_long_text_count_as_the_whole(monkeypatch):
    """Wherever a text is cut, its n-grams are those of the whole text, counted by plain loops."""
    from collections import Counter

    from tierloom.llm import langid

    is_letter = langid.letters()
    text = "Der  schnelle, braune Fuchs - springt über 12 Hunde!  \n\n Ende ß x" * 3
    whole = langid.counts(text, is_letter)
    codes = " ".join("".join(c if c.isalpha() else " " for c in f" {text.lower()} ").split())
    grams = Counter(g for n in (1, 2, 3) for i in range(len(codes) + 3 - n) if (g := f" {codes} "[i : i + n]) != " ")
    assert whole.sum() == sum(grams.values())
    for size in (1, 2, 3, 5, 7, 64):
        monkeypatch.setattr(langid, "PIECE", size)
        assert (langid.counts(text, is_letter) == whole).all(), size
