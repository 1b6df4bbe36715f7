"""The pipeline, stage by stage and as a whole; queries of the package against SQL."""

import pyarrow as pa
import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

import corpus_pipeline
from tierloom.llm import near_dedup
from tierloom.llm.queries import ORACLES, QUERIES
from tierloom.llm.shared import read
from tierloom.session import BATCH_BYTES


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    base, docs, out = tmp_path_factory.mktemp("stages"), read(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(base / name))
        docs = out[name] = spark.read.parquet(str(base / name))
    return out


def test_stages_keep_columns(stages, spark, sf_dir):
    columns = read(spark, sf_dir, "documents").columns
    assert [stages[n].columns for n in list(stages)[:-1]] == [columns] * 4


def test_duplicates_go_and_nothing_else(stages):
    ids = {n: {r["doc_id"] for r in stages[n].select("doc_id").collect()} for n in ("language_id", "exact_dedup", "near_dedup")}
    texts = {r["doc_id"]: " ".join(r["text"].split()) for r in stages["language_id"].collect()}
    first = {}
    for i in sorted(ids["language_id"]):
        first.setdefault(texts[i], i)
    assert ids["exact_dedup"] == set(first.values())
    classes = near_dedup.near_duplicates(stages["exact_dedup"], 5, 80).collect()
    assert ids["near_dedup"] == {r["component_id"] for r in classes}


def test_mix_is_encoded(stages):
    mixed, coded = stages["mixing"], stages["bpe"]
    assert coded.count() == mixed.count()
    assert all(r["n_tokens"] == len(r["ids"]) for r in coded.select("n_tokens", "ids").limit(50).collect())


def test_run_is_the_last_stage(spark, sf_dir, stages):
    key = lambda r: (r["doc_id"], r["ids_sha256"])
    assert sorted(map(key, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(key, stages["bpe"].collect()))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCE = "the cat and the dog went to the house by the river because it was late and they were cold"


def through(spark, docs, folder):
    """Rows that each stage returns for a table."""
    docs.write.parquet(str(folder / "documents.parquet"))
    out, rows = {}, read(spark, str(folder), "documents")
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, rows, str(folder)).write.parquet(path)
        rows = spark.read.parquet(path)
        out[name] = rows.collect()
    return out


def test_nulls_repeats_blanks_and_clashing_names(spark, rows, tmp_path):
    other = " ".join(f"{w}{i}" for i, w in enumerate(SENTENCE.split()))
    data = [(i, f"{SENTENCE} number {i} of these texts and the {i * 7} others", "en", "web", 1) for i in range(20)]
    data += [(None, None, None, None, None), (30, None, "en", "web", 0), (31, "", "en", None, 0), (32, " \n\t ", "en", "web", 4), (33, "123 456", "en", "web", 7)]
    data += [(40, SENTENCE, "en", None, None)] * 3 + [(41, SENTENCE.replace(" ", "  "), None, "web", 9), (None, SENTENCE, "en", "web", 9), (42, SENTENCE * 300, "en", "web", 9)]
    data += [(43, other, "en", "a", 1)]
    extra = {"at": 1, "id": 2, "size": 3, "copies": 4, "digest": 5, "kept": 6, "_at": 7, "component_id": 8}
    docs = rows(SCHEMA, *data).withColumns({c: F.lit(v) for c, v in extra.items()})
    found = through(spark, docs, tmp_path)
    assert not {30, 31, 32, 33} & {r["doc_id"] for r in found["language_id"]}, "texts without a letter go"
    assert all(r["digest"] == 5 and r["kept"] == 6 for r in found["near_dedup"])
    same = [r["doc_id"] for r in found["exact_dedup"] if " ".join(r["text"].split()) == SENTENCE]
    assert same == [40], "of equal texts the least id stays, once"
    assert len(found["bpe"]) == len(found["mixing"]) > 0


def test_tables_without_rows_or_texts(spark, rows, tmp_path):
    for name, docs in (("empty", rows(SCHEMA, (1, "a", "en", "s", 1)).where("false")), ("nulls", rows(SCHEMA, (None, None, None, None, None), (1, None, "en", "s", 0)))):
        folder = tmp_path / name
        folder.mkdir()
        assert all(found == [] for found in through(spark, docs, folder).values())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, sf_dir):
    assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])


@pytest.mark.parametrize("name", ["language_id", "near_dedup", "mixing", "bpe"])
def test_stages_bound_what_python_gets_at_once(name, spark, sf_dir):
    """A stage by itself, in a session that nobody configured: 10,000 long texts do not reach a worker together."""
    held = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, "67108864b")
    try:
        dict(corpus_pipeline.STAGES)[name](spark, read(spark, sf_dir, "documents"), sf_dir)
        texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))
        sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
        assert max(r["n"] for r in sizes.collect()) < 8_000_000
    finally:
        spark.conf.set(BATCH_BYTES, held)
