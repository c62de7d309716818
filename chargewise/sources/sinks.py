"""Output sink: publish a feed as a catalog table without ever leaving readers a broken one.

A plain overwrite drops the old table before the new rows are computed, so a job that fails in its
write destroys last week's feed. `publish` writes the new rows to a table of their own, checks them, and
swaps the names; until the swap the old table stands untouched. `keep_window` also files the published
rows under their reporting window in a history table, replacing that window and no other.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargewise import schemas

INCOMING, OUTGOING, HISTORY = "__incoming", "__outgoing", "_HISTORY"
WINDOW_COLUMNS = ("WINDOW_START", "WINDOW_END")

Check = Callable[[DataFrame], str | None]       # what is wrong with the written rows, or None


class PublishError(RuntimeError):
    """The new rows failed a check; the old table stands."""


def overwrite_table(df: DataFrame, table: str) -> None:
    publish(df, table)


def publish(df: DataFrame, table: str, schema: T.StructType | None = None, checks: Sequence[Check] = ()) -> DataFrame:
    """Replace `table` by the rows of `df`; on any failure before the swap the old table stays as it was.

    `schema`: the column names and types the table must have. `checks` see the written rows. What an
    interrupted run has left behind is put right first (`recover`).
    """
    spark = df.sparkSession
    recover(spark, table)
    incoming = f"{table}{INCOMING}_{uuid.uuid4().hex[:12]}"
    try:
        if schema is not None:
            _must_match(df, schema, table)
        df.write.mode("error").saveAsTable(incoming)
        written = spark.table(incoming)
        wrong = [message for check in checks if (message := check(written))]
        if wrong:
            raise PublishError(f"{table} not published: {'; '.join(wrong)}")
        _swap(spark, incoming, table)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {incoming}")
        raise
    return spark.table(table)


def _must_match(df: DataFrame, schema: T.StructType, table: str) -> None:
    got, want = schemas.columns_and_types(df.schema), schemas.columns_and_types(schema)
    if got != want:
        raise PublishError(f"{table} not published: it has the columns {got}, not {want}")


def _swap(spark: SparkSession, incoming: str, table: str) -> None:
    outgoing = f"{table}{OUTGOING}"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {outgoing}")
    try:
        spark.sql(f"ALTER TABLE {incoming} RENAME TO {table}")
    except BaseException:
        recover(spark, table)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {outgoing}")


def recover(spark: SparkSession, table: str) -> None:
    """After a run that died between the two renames of a swap: the old table takes its name again, or goes
    if the new one is in place."""
    outgoing = f"{table}{OUTGOING}"
    if not spark.catalog.tableExists(outgoing):
        return
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {outgoing}")
    else:
        spark.sql(f"ALTER TABLE {outgoing} RENAME TO {table}")


def not_empty(written: DataFrame) -> str | None:
    return None if written.take(1) else "no rows"


def no_nulls(*columns: str) -> Check:
    """No row may lack a value in these columns."""
    def check(written: DataFrame) -> str | None:
        found = written.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
        named = [f"{found[c]} rows without {c}" for c in columns if found[c]]
        return ", ".join(named) or None

    return check


def keep_window(published: DataFrame, table: str, start: dt.date, end: dt.date) -> str:
    """File a published feed under its window in `<table>_HISTORY`, partitioned by window.

    Only the window's partition changes: Spark writes the rows to a staging folder and moves them over the
    partition when all tasks are done. A window whose feed is empty now loses its partition.
    """
    spark, history = published.sparkSession, f"{table}{HISTORY}"
    rows = published.select("*", F.lit(start).cast("date").alias(WINDOW_COLUMNS[0]), F.lit(end).cast("date").alias(WINDOW_COLUMNS[1]))
    if not spark.catalog.tableExists(history):
        rows.limit(0).write.partitionBy(*WINDOW_COLUMNS).saveAsTable(history)
    if not published.take(1):
        spark.sql(f"ALTER TABLE {history} DROP IF EXISTS PARTITION ({WINDOW_COLUMNS[0]} = DATE'{start}', {WINDOW_COLUMNS[1]} = DATE'{end}')")
        return history
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        rows.select(*spark.table(history).columns).write.mode("overwrite").insertInto(history)
    finally:
        spark.conf.set(key, before)
    return history
