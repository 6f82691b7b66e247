"""Session settings this engine wants, and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings. Skewed join partitions are split at run time, also where that costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.streaming.stopTimeout": "60s",
    # The default of 100 compiled stages is soon full when all models run in one session.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Plans are built from many small expressions; recording the Python line of each one doubles the time for that.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tillwork", master: str | None = None, **extra: str) -> SparkSession:
    """A session with SETTINGS. On a cluster leave ``master`` to spark-submit and size shuffle partitions there."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one that the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="tillwork-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
