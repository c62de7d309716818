"""Write a small, selective intermediate result and read it back.

A window's freight rows or status-line keys are a small slice of history
tables. Written as parquet under the cluster's checkpoint folder, the slice
has a known size when the next joins are planned: Spark broadcasts it when
it is under the broadcast limit (so the history table is scanned, not
shuffled), and otherwise plans a shuffled join whose history side is pruned
by a bloom filter of the slice (`joins.exists_in(written=True)`). Reading a
written slice also cuts the lineage, so a lost executor does not send
recomputation back to the history.
"""

from __future__ import annotations

import datetime
import functools
import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from chargewise.session import ensure_checkpoint_dir

# All working sets of one process live under one dated folder, so a retention
# policy on the checkpoint folder can expire whole runs by age.
RUN_FOLDER = f"{datetime.datetime.now():%Y%m%d-%H%M%S}-{os.getpid()}-{uuid.uuid4().hex[:8]}"

# Folders under the checkpoint folder that hold one entry per run or table.
WORK_FOLDERS = ("chargewise-work", "chargewise-llm")

# Written slices are mostly keys that repeat their neighbours' beginnings: zstd halves what snappy leaves of them.
COMPRESSION = "zstd"

# A written slice is never computed again, so its shuffle files can go at once; else they lie on the executors' disks until
# the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def materialize(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    folder = _job_folder.get() or _root(spark)
    path = f"{folder}/{uuid.uuid4().hex}"
    write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def write(df: DataFrame, path: str) -> None:
    """`df` as files under `path`; the shuffles behind it leave nothing."""
    conf = df.sparkSession.conf
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP)


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/chargewise-work/{RUN_FOLDER}"


@contextmanager
def job_scope(spark: SparkSession):
    """Working sets written inside are removed at the end; nothing read from them may leave."""
    folder = f"{_root(spark)}/job-{uuid.uuid4().hex}"
    token = _job_folder.set(folder)
    try:
        yield
    finally:
        _job_folder.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it is (local, distributed, object store)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def expire(spark: SparkSession, keep: datetime.timedelta) -> list[str]:
    """Delete what runs have left under the checkpoint folder and nobody has written to for longer than `keep`.

    Jobs remove their own working sets; this is for those of jobs that died, of queries whose results are read later, and
    of the training-data operators. One entry per run or table reaches the driver.
    """
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf, gone = spark.sparkContext._jsc.hadoopConfiguration(), []
    limit = (datetime.datetime.now() - keep).timestamp() * 1000
    for top in WORK_FOLDERS:
        base = fs_path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{top}")
        fs = base.getFileSystem(conf)
        if not fs.exists(base):
            continue
        for entry in fs.listStatus(base):
            inside = [entry, *(fs.listStatus(entry.getPath()) if entry.isDirectory() else [])]
            if max(s.getModificationTime() for s in inside) < limit and fs.delete(entry.getPath(), True):
                gone.append(entry.getPath().toString())
    return gone


def scoped(job):
    """A job whose first argument is the session and whose result is a written table or a message."""
    @functools.wraps(job)
    def run(spark, *args, **kwargs):
        with job_scope(spark):
            return job(spark, *args, **kwargs)
    return run
