"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC time on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


# Results need UTC. The rest is for scale: without the forced split, Spark leaves a
# skewed join alone whenever an aggregate on the same key follows it.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session made elsewhere."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a ``local[...]`` master, where driver and
    executors are the same process.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or cleared."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
