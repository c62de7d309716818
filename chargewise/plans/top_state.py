"""Top status kept up to date week by week instead of ranked from the whole history.

A status row can only be a line's top row if its time is the latest of one of the line's schedules. The state is the
set of these rows, in the columns of the status history: a fraction of it, with all that later weeks can change. A week is
merged by adding its rows and keeping, per line, those that still compete; the history isn't read. The latest time of each
schedule is the greatest among the rows held, so the rows are the whole state.

Rows that come late (dated at or before rows merged already) can bring superseded rows of their line back into the
competition, so their lines are taken from the history again. Merging the same week twice is such a case, and
changes nothing. Whether a line is known, dated and on a PO order is asked when the state is ranked: these
are the same for all rows of a schedule, so they can wait.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargewise.operators import joins
from chargewise.operators.working_set import materialize

SCHEDULE = ("order_key", "line_key", "sched")
FEW_LINES = 500_000             # so many hashed keys are broadcast: some 30 MB


def competing(rows: DataFrame) -> DataFrame:
    """The status rows whose time is the latest of some schedule of their line.

    The rows are shuffled once, to their line, and judged there in windows. A window takes a line to one task, so the lines of
    a bucket with too many rows for that (`rule_710.hot_buckets`) are joined to their schedules' latest times instead.
    """
    from chargewise.plans.rule_710 import hot_buckets, line_bucket

    rows = rows.filter(F.col("line_key").isNotNull())
    hot = hot_buckets(rows)
    if not hot:
        return _competing_in_windows(rows)
    is_hot = line_bucket().isin(hot)
    return _competing_in_windows(rows.filter(~is_hot)).unionByName(_competing_by_joins(rows.filter(is_hot)))


def _competing_in_windows(rows: DataFrame) -> DataFrame:
    # The first window asks for the rows of a line together: the other two need no shuffle of their own then.
    of_line = F.max("status_ts").over(Window.partitionBy("line_key"))
    of_schedule = F.max("status_ts").over(Window.partitionBy("line_key", "order_key", "sched"))
    judged = (rows.withColumn("_of_line", of_line).withColumn("_of_schedule", of_schedule)
              .withColumn("_ended", F.max(F.col("status_ts") == F.col("_of_schedule")).over(Window.partitionBy("line_key", "status_ts"))))
    return judged.filter((F.col("status_ts") == F.col("_of_line")) | F.col("_ended")).select(*rows.columns)


def _competing_by_joins(rows: DataFrame) -> DataFrame:
    times = (rows.groupBy(*SCHEDULE).agg(F.max("status_ts").alias("_ts"))
             .select(F.col("line_key").alias("_line"), "_ts").distinct())
    return rows.join(times, (F.col("line_key") == F.col("_line")) & (F.col("status_ts") == F.col("_ts")), "left_semi")


def merged(state: DataFrame, new_rows: DataFrame, history: DataFrame) -> DataFrame:
    """The state with the rows of another window. `history`: all status rows, those of the window too; it is read only for
    the lines of late rows.

    Where the window has few lines, only theirs are judged again and written; the rest of the state is read where it is,
    without them. So a week costs its own rows and a scan, and no copy or shuffle of the state. `new_rows` is read several times.
    """
    new_rows = new_rows.select(*state.columns)       # without the partition column of a history stored by date
    through = state.agg(F.max("status_ts")).first()[0]
    if through is None:
        return competing(new_rows)
    late = new_rows.filter(F.col("status_ts") <= F.lit(through))
    if not late.take(1):
        # By a hash of the key: lines that share one are judged again together, which changes nothing.
        lines = materialize(new_rows.select(F.xxhash64("line_key").alias("_line")).distinct())
        if lines.count() > FEW_LINES:
            return materialize(competing(state.unionByName(new_rows)))
        own, few = F.xxhash64("line_key") == F.col("_line"), F.broadcast(lines)
        changed = materialize(competing(state.join(few, own, "left_semi").unionByName(new_rows)))
        return state.join(few, own, "left_anti").unionByName(changed)
    lines = materialize(late.select("line_key").distinct())
    again = joins.exists_in(history, lines, "line_key", written=True)
    others = joins.anti_keeping_null(state.unionByName(new_rows), lines, "line_key")
    return materialize(competing(others.unionByName(again.select(*state.columns))))


def until(rows: DataFrame, day: dt.date) -> DataFrame:
    """Status rows up to the end of a day."""
    return rows.filter(F.col("status_ts") < F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz"))
