"""Session settings the jobs expect, and the shared scratch folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # all instants are UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the JVM never compiles methods above 8000 bytes; past that, split code runs faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # shuffle files go when the write or read that made them ends, not when the driver collects garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session with the settings above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session built elsewhere; all of them can change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir, the storage every executor can reach.

    Only where the cluster names none (local runs and tests) a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="orderloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
