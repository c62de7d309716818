"""Histories stored in buckets of their join key, or by the date that the rules' windows bound.

The reports over whole histories (`top_status`, `latest_cancel`, `unit_cost`) join and aggregate by line or by PO. Stored in
buckets of that key, each task reads the buckets of all tables that belong together, and no history is shuffled:
neither for the aggregates (bucketed by the line, a schedule's rows are together) nor for the joins on the
line and a time. `LAYOUT_CONF` lets Spark use buckets of a part of a join's keys.

The weekly rules read one window of `rel_status`, `fsc` and `ltl`. Stored by that date (`write_by_date`), the other dates'
partitions are not opened, and a week that is delivered again replaces its own dates only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from chargewise import schemas
from chargewise.functions import dates
from chargewise.sources.inputs import Inputs, named

BUCKET_KEYS: Mapping[str, str] = {"rel_status": "line_key", "oms_line": "line_key", "cancel_line": "line_key", "po_line": "po_no"}

LAYOUT_CONF = {
    # A join on (line, time) may run on buckets of the line.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The planner drops a bucketed read where it sees no use for it before the joins are adapted; keep it.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def tune_for_buckets(spark: SparkSession) -> SparkSession:
    for key, value in LAYOUT_CONF.items():
        spark.conf.set(key, value)
    return spark


def write_buckets(df: DataFrame, relation: str, table: str, buckets: int) -> None:
    """Store a history as a table bucketed and sorted by its key. One file per bucket: rows are dealt by the key first."""
    key = BUCKET_KEYS[relation]
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)


def with_buckets(inputs: Inputs, tables: Mapping[str, str], spark: SparkSession) -> Inputs:
    """`inputs` with some relations read from bucketed tables (relation -> table), e.g. kept by `write_buckets`."""
    tune_for_buckets(spark)
    for relation, table in tables.items():
        inputs = inputs.with_frame(relation, spark.table(table).select(*inputs[relation].columns))
    return inputs


# What keeps the rows of one date apart, so that a date of any size is written by many tasks.
_SPREAD_BY: Mapping[str, str] = {"rel_status": "line_key", "fsc": "line_key", "ltl": "pro_no"}


def write_by_date(df: DataFrame, relation: str, path: str, unit: str = "day") -> None:
    """Store rows of a history under `path`, partitioned by the day (or month) of its window date.

    Dates that `df` holds are replaced, others stay as they are: hand over whole dates. Rows without a date are kept in a
    partition of their own, which no window reads. Rows are dealt by ranges of (date, key): each task writes a few
    dates, and a date that holds a third of all rows is shared by many tasks.
    """
    part, key = f"{schemas.WINDOW_DATE[relation]}_{unit}", _SPREAD_BY[relation]
    (df.withColumn(part, dates.partition_date(schemas.WINDOW_DATE[relation], unit))
       .repartitionByRange(part, key).sortWithinPartitions(part, key)
       .write.partitionBy(part).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


def with_dates(inputs: Inputs, paths: Mapping[str, str], spark: SparkSession) -> Inputs:
    """`inputs` with some relations (relation -> path) read as `write_by_date` stores them."""
    for relation, path in paths.items():
        inputs = inputs.with_frame(relation, named(spark.read.parquet(path), relation))
    return inputs
