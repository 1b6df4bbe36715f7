"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on: wall clocks are computed from UTC, a rerun of a partitioned write
# replaces only the partitions it produces, and AQE splits skewed partitions at run time. The JVM never compiles a
# method above 8000 bytes, so a wider projection runs faster without whole-stage code. AQE makes no hash join of a
# shuffled one: it goes by compressed bytes, of which copies have few, takes the left side as well, and a hash map
# cannot spill. Batches for Python are bounded in bytes, since 10,000 texts are held several times over, on both sides
# of the pipe.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    BATCH_BYTES: "4194304b",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tierloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(RUNTIME_CONF) | {"spark.ui.enabled": "false"}
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local master may fall back to a machine-local
    temporary folder, since there all tasks share one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tierloom-")
    return f"{base.rstrip('/')}/tierloom-{uuid.uuid4().hex}"
