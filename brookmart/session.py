"""Session settings and the shared folder used for checkpoints and written state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs a later step an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state lives in RocksDB: it spills to disk and is uploaded incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; on a cluster, master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run, below the shared folder named in ``spark.checkpoint.dir``.

    A cluster names that folder, and every executor can reach it. Only where it is unset (local
    tests) a temporary folder is taken instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="brookmart-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
