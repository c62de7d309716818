"""Date helpers: reporting week, window predicates, run-date stamp."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def previous_week(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """The last full Sunday-Saturday week that ended before `as_of`.

    Its Saturday is the latest one before the run date (six days back for a
    Friday run, one for a Sunday run), its Sunday six days earlier.
    """
    saturdays = (as_of - dt.timedelta(days=back) for back in range(1, 8))
    end = next(day for day in saturdays if day.isoweekday() == 6)
    return end - dt.timedelta(days=6), end


def previous_week_col(as_of: Column) -> tuple[Column, Column]:
    """Column form of `previous_week` (Spark's dayofweek: Sunday = 1)."""
    start = F.date_sub(as_of, F.dayofweek(as_of) + 6)
    return start, F.date_add(start, 6)


def require_window(start: dt.date | None, end: dt.date | None) -> None:
    """A missing bound would match nothing and empty the output without a word."""
    if start is None or end is None:
        raise ValueError("the reporting window needs a start and an end date")


def within(col: Column, start: dt.date, end: dt.date) -> Column:
    """Inclusive window on a DATE column (pushed into the scan as two bounds)."""
    require_window(start, end)
    return col.between(F.lit(start), F.lit(end))


def ts_within(col: Column, start: dt.date, end: dt.date) -> Column:
    """`to_date(ts) BETWEEN start AND end` written as a half-open range on the raw
    timestamp, so parquet row-group statistics can skip data."""
    require_window(start, end)
    lo = F.lit(start.isoformat()).cast("timestamp_ntz")
    hi = F.lit((end + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return (col >= lo) & (col < hi)


# Names of the partition columns by which a history may be stored: the date column's name and one of these.
PARTITION_UNITS = ("day", "month")


def partition_date(column: str, unit: str) -> Column:
    """The value of the partition column `<column>_<unit>`: the row's day, or the first day of its month."""
    if unit not in PARTITION_UNITS:
        raise ValueError(f"histories are stored by {' or '.join(PARTITION_UNITS)}, not by {unit!r}")
    return F.to_date(column) if unit == "day" else F.trunc(F.to_date(column), "month")


def rows_in(history: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """The rows whose DATE or timestamp `column` falls in the window, both days included.

    Where the history is stored by that date (it has `<column>_day` or `<column>_month`), the window also bounds the
    partition column, so other partitions are not listed or opened; the bounds on the raw column decide in either case.
    """
    holds = within if dict(history.dtypes)[column] == "date" else ts_within
    rows = history.filter(holds(F.col(column), start, end))
    for unit, first in zip(PARTITION_UNITS, (start, start.replace(day=1))):
        if f"{column}_{unit}" in history.columns:
            rows = rows.filter(within(F.col(f"{column}_{unit}"), first, end))
    return rows


def audit_stamp(as_of: dt.date | None) -> Column:
    """Run date as 'yyyyMMdd' text; today's date when no run date is given."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_format(day, "yyyyMMdd")
