"""Exact deduplication as a stateful stream.

Each row arrives as digest of its normalised text, id and content locator (the row's place in the scan). A
streaming aggregate keeps, per digest and without expiry, the identity of the row that stays and the number of
arrivals; the state lies in RocksDB and is checkpointed to the shared folder, so a restarted stream goes on
where it was. Partial sums before the shuffle take the load off a digest with many copies.

A digest is only a hint: every row that hits a stored digest is compared with the stored row's full bytes,
found through both locators. Digests under which different texts were met are grouped anew by the texts.

Defined results: null counts as the empty text. Of rows with equal text and equal id one stays, the first in
the scan; a row without an id stays only if all its copies lack one. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierloom.llm import bloom
from tierloom.llm.shared import SPACE, in_file_order, rows_at, store
from tierloom.session import scratch_dir

# State on disk, and no space set aside beforehand in each of many small stores.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """White space runs as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _first() -> Column:
    return F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "at")).alias("first")


def remember(spark: SparkSession, arrivals: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over the arrivals at a path until none is left: per digest ``first`` and ``size``.

    ``files_per_batch`` bounds a micro-batch; by default all files that are there make one.
    """
    base = scratch_dir(spark)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    state = reader.parquet(arrivals).groupBy("digest").agg(_first(), F.count("*").alias("size"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/changed/batch={number}")

    before = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{base}/state")
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    key = dict(f.split(" ") for f in schema.split(", "))["id"]
    changed = spark.read.schema(f"digest string, first struct<no_id: boolean, id: {key}, at: bigint>, size bigint, batch int").option("basePath", f"{base}/changed")
    if query.lastProgress is None and not query.recentProgress:
        return spark.createDataFrame([], f"digest string, first struct<no_id: boolean, id: {key}, at: bigint>, size bigint")
    table = changed.parquet(f"{base}/changed")
    if files_per_batch is None:
        return table.drop("batch")
    return table.groupBy("digest").agg(F.max(F.struct("batch", "first", "size")).alias("last")).select("digest", "last.first", "last.size")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Per row: ``at`` (place in the scan), ``id``, ``keep_id``, ``group_size``, ``kept`` and ``digest``."""
    spark = docs.sparkSession
    source = in_file_order(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")))
    rows = source.select(F.monotonically_increasing_id().alias("at"), "id", normalised(F.col("text")).alias("text"))
    arrivals = f"{scratch_dir(spark)}/arrivals"
    rows.select("at", "id", digest(F.col("text")).alias("digest")).write.parquet(arrivals)
    schema = f"at bigint, id {docs.schema[id_col].dataType.simpleString()}, digest string"
    came = spark.read.schema(schema).parquet(arrivals)
    if came.isEmpty():
        return _result(came.withColumns({"keep_at": F.col("at"), "keep_id": F.col("id"), "size": F.lit(0).cast("long")}))

    stored = store(remember(spark, arrivals, schema, files_per_batch), "stored")
    held = store(came.join(stored.select("digest", F.col("first.at").alias("keep_at"), F.col("first.id").alias("keep_id"), "size"), "digest"), "held")

    differ = _different(rows, held.where("at <> keep_at").select("at", "keep_at", "digest"))
    if not differ.isEmpty():
        held = _regrouped(rows, held, differ)
    return _result(held)


def _result(held: DataFrame) -> DataFrame:
    return held.select("at", "id", "keep_id", F.col("size").alias("group_size"), (F.col("at") == F.col("keep_at")).alias("kept"), "digest")


def _different(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests of hits whose bytes are not those of the stored row."""
    wanted = store(hits.select(F.explode(F.array("at", "keep_at")).alias("at")).distinct(), "wanted")
    blocks = bloom.block_count(wanted.count())
    texts = rows.select("at", "text")
    if bloom.fits(blocks):
        texts = bloom.probe(texts, "at", store(bloom.build(wanted, "at", blocks), "bloom"), blocks).where("maybe").drop("maybe")
    texts = store(texts.join(wanted, "at"), "texts")
    mine = hits.join(texts, "at").select("keep_at", "digest", F.col("text").cast("binary").alias("mine"))
    kept = texts.select(F.col("at").alias("keep_at"), F.col("text").cast("binary").alias("kept"))
    return store(mine.join(kept, "keep_at").where("mine <> kept").select("digest").distinct(), "differ")


def _regrouped(rows: DataFrame, held: DataFrame, differ: DataFrame) -> DataFrame:
    """The table with rows of the given digests grouped by their texts."""
    met = store(held.join(differ, "digest", "left_semi").select("at", "id", "digest").join(rows.select("at", "text"), "at"), "met")
    groups = store(met.groupBy("text").agg(_first(), F.count("*").alias("size")).select("text", F.col("first.at").alias("keep_at"), F.col("first.id").alias("keep_id"), "size"), "groups")
    rest = held.join(differ, "digest", "left_anti")
    return rest.unionByName(met.join(groups, "text").select("at", "id", "digest", "keep_at", "keep_id", "size"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept."""
    source = in_file_order(docs)
    return rows_at(source, exact_duplicates(source, id_col, text).where("kept"), "_at")
