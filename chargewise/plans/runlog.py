"""Run log: one row per job run, failed ones too, and each job's latest runs.

A run logs its window, what it read, dropped (by exclusion) and wrote and the amount, as gathered by its own writes
(`operators.audit`). Every row is written to a folder of its own, so jobs that end at the same time don't
disturb each other. The newest run of a rule tells whether its feed is good to be combined (`stale_feeds`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargewise.operators.audit import AMOUNT, Audit
from chargewise.sources.inputs import optional_table

PUBLISHED, FAILED = "PUBLISHED", "FAILED"
REPORT_COLUMNS = ("JOB", "WINDOW_START", "WINDOW_END", "RUN_DATE", "STARTED_AT", "ROWS_IN", "ROWS_OUT", "AMOUNT_TOTAL")

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("JOB", T.StringType()),
    T.StructField("WINDOW_START", T.DateType()),
    T.StructField("WINDOW_END", T.DateType()),
    T.StructField("RUN_DATE", T.DateType()),
    T.StructField("STARTED_AT", T.TimestampNTZType()),
    T.StructField("ROWS_IN", T.LongType()),
    T.StructField("ROWS_OUT", T.LongType()),
    T.StructField("AMOUNT_TOTAL", T.DecimalType(38, 6)),
    T.StructField("STATUS", T.StringType()),
    T.StructField("OUTPUT_TABLE", T.StringType()),
    T.StructField("DROPPED", T.MapType(T.StringType(), T.LongType())),
    T.StructField("ERROR", T.StringType()),
])


@dataclass
class Run:
    """One run of a job."""

    job: str
    start: dt.date | None
    end: dt.date | None
    run_date: dt.date
    output: str | None = None
    amount: str | None = "CHARGEBACK_AMOUNT"
    started_at: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None))
    audit: Audit = field(default_factory=Audit)

    def row(self, spark: SparkSession, written: DataFrame | None = None, error: BaseException | None = None) -> DataFrame:
        """The run as one row, once its writes are done. `written`: the output as written; a lost executor can make
        observed rows count twice, so where the files hold another number of rows, they are the ones that count."""
        rows_in = rows_out = total = None
        dropped: dict[str, int] = {}
        if error is None:
            rows_in, dropped = self.audit.rows_read(), self.audit.dropped()
            rows_out, total = self.audit.rows_written()
            if written is not None and written.count() != rows_out:
                rows_out, total = totals(written, self.amount)
        values = (self.job, self.start, self.end, self.run_date, self.started_at, rows_in, rows_out, total,
                  PUBLISHED if error is None else FAILED, self.output, dropped,
                  None if error is None else f"{type(error).__name__}: {error}"[:2000])
        return spark.createDataFrame([values], RUN_LOG_SCHEMA)


def totals(output: DataFrame, amount: str | None) -> tuple[int, Decimal | None]:
    """Rows and amount of an output, by a scan of it."""
    sums = F.sum(F.col(amount).cast(AMOUNT)) if amount and amount in output.columns else F.lit(None).cast(AMOUNT)
    found = output.agg(F.count(F.lit(1)).alias("n"), F.max(sums) if not amount else sums.alias("amount")).first()
    return found[0], found[1]


@contextmanager
def logged(spark: SparkSession, run: Run, log_path: str | None) -> Iterator[Audit]:
    """Runs the block as `run`: its row is logged at the end, as failed if the block raises."""
    try:
        yield run.audit
    except BaseException as error:
        if log_path:
            append_run(run.row(spark, error=error), log_path)
        raise
    if log_path:
        append_run(run.row(spark, optional_table(spark, run.output) if run.output else None), log_path)


def append_run(row: DataFrame, log_path: str) -> None:
    row.coalesce(1).write.parquet(f"{log_path.rstrip('/')}/{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex}")


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(log_path)


def latest_runs(log: DataFrame, n: int = 5, job: str | None = None) -> DataFrame:
    """The `n` newest runs of each job, or of one job, by start time (then run date): a top-k report."""
    if job is not None:
        log = log.where(F.col("JOB") == job)
    newest = Window.partitionBy("JOB").orderBy(F.col("STARTED_AT").desc_nulls_last(), F.col("RUN_DATE").desc_nulls_last())
    return log.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n).drop("_n").orderBy(
        F.col("STARTED_AT").desc_nulls_last(), "JOB")


# --- freshness

class StaleFeeds(RuntimeError):
    """Feeds that must not be combined, with the reason for each."""

    def __init__(self, reasons: Mapping[str, str]):
        self.reasons = dict(reasons)
        super().__init__("; ".join(f"rule {r}: {why}" for r, why in reasons.items()))


def stale_feeds(spark: SparkSession, log: DataFrame, tables: Mapping[str, str],
                windows: Mapping[str, tuple[dt.date, dt.date]] | None = None) -> dict[str, str]:
    """Why the feeds of some rules are not the ones to combine; `tables`: rule -> feed table, `windows`: rule -> window wanted.

    A rule without a table and without a logged run was never published and is not stale. One row per rule reaches the driver.
    """
    newest = {r["JOB"]: r for r in latest_runs(log.where(F.col("JOB").isin([f"rule_{r}" for r in tables])), 1).collect()}
    out = {}
    for rule, table in tables.items():
        run, feed = newest.get(f"rule_{rule}"), optional_table(spark, table)
        if run is None:
            if feed is not None:
                out[rule] = f"no logged run wrote {table}"
        elif run["STATUS"] != PUBLISHED:
            out[rule] = f"its last run ({run['WINDOW_START']} to {run['WINDOW_END']}) failed: {run['ERROR']}"
        elif feed is None:
            out[rule] = f"{table} is gone"
        elif (wanted := (windows or {}).get(rule)) and (run["WINDOW_START"], run["WINDOW_END"]) != tuple(wanted):
            out[rule] = f"its feed is of {run['WINDOW_START']} to {run['WINDOW_END']}, not of {wanted[0]} to {wanted[1]}"
        elif (rows := feed.count()) != run["ROWS_OUT"]:
            out[rule] = f"{table} holds {rows} rows, its run wrote {run['ROWS_OUT']}"
    return out
