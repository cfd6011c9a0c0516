"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; every one may be changed on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key may hold a third of all rows: let AQE split skewed join partitions
    # even where that costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Also after a small patch the master table is read by bucket, so what is written
    # from it stays one file per bucket.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # Buckets of the master table are written as one sorted file each: joins on
    # its key need not sort it again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # The ordered merge aggregates run as object-hash or sort aggregates; keep
    # a useful number of groups hashed before they fall back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "firmfold", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    # Without a recorded call site per Column call, large plans build faster.
    builder = SparkSession.builder.appName(app).config(
        "spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder that ``spark.checkpoint.dir`` names.

    Where neither the setting nor the context has one, a local session gets its own,
    removed at exit; on a cluster it must be named, as no machine-local folder is shared.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="firmfold-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to a scratch folder and read again: made once, its size known to the planner."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
