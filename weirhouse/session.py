"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Only settings that differ from Spark's defaults or that results rest on.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(app: str = "weirhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def allow_repeated_names(spark: SparkSession) -> None:
    """An object that repeats a name is read with its last value, also as VARIANT."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="weirhouse-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path every executor can reach.

    Uses the folder the cluster names in ``spark.checkpoint.dir``.  Where that
    is unset a local master gets a temporary folder; a real cluster has no
    machine-local fallback and the call fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
