"""Spark session settings for the chargeback jobs.

On a cluster the session is built by the platform; `tune(spark)` only
adds the SQL settings the jobs rely on and fills in a checkpoint folder
when none is configured (tests and local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings the jobs are written against. All are runtime-settable.
JOB_SQL_CONF = {
    # Dates are compared as calendar days; pin the zone so `to_date(ts)` is stable.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones,
    # turn joins whose measured side is small into broadcast joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # Keys that repeat their neighbours' beginnings take a tenth of their size in shuffles and files: 128 MB of them are
    # millions of rows, which a task sorts on disk.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
    # Where each measured partition of a join's smaller side is that small, it is hashed and the larger side isn't sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
    # Semi-join reduction of the large side of a join by a runtime bloom filter.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Broadcast a join side only below this size: estimated from plan statistics
    # at planning time, measured from the shuffle output under AQE. The estimate comes from the size of a zstd file, where
    # a million keys can take 500 KB; their relation, built on the driver, takes 140 MB.
    "spark.sql.autoBroadcastJoinThreshold": "256KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Build the bloom filter from a selective side up to this size (default 10MB) and apply it to scans
    # from this size on before their shuffle (default 10GB: a smaller history would be shuffled whole).
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "2GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    # One query meets up to a dozen histories; the default stops at ten filters.
    "spark.sql.optimizer.runtimeFilter.number.threshold": "64",
    # 16 MB of bits whatever the history, three a key: of 30 million keys they still pass one in nine others, and every
    # task that builds a filter ships the bits it set, so a small slice costs a quarter of what twelve bits a key cost.
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "32000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "32000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "134217728",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "134217728",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in JOB_SQL_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


_fallback_dir: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; with a local master, make a scratch one if unset.

    On a cluster without the setting this is an error: executors would write to their own disks.

    `spark.checkpoint.dir` cannot be changed on a running session, so a scratch
    folder (tests, local runs without the setting) is kept per process and
    handed to the SparkContext.
    """
    global _fallback_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    current = context.getCheckpointDir() if context is not None else None
    folder = configured or current or _fallback_dir
    if not folder:
        if str(spark.conf.get("spark.master", "")).split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _fallback_dir = tempfile.mkdtemp(prefix="chargewise-ckpt-")
    if context is not None and not current:
        context.setCheckpointDir(folder)
    return folder


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "chargewise", event_log_dir: str | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Single-JVM session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.checkpoint.dir", os.environ.get("CHARGEWISE_CHECKPOINT_DIR")
                or tempfile.mkdtemp(prefix="chargewise-ckpt-"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CHARGEWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.files.maxPartitionBytes", "128MB")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
