"""Join helpers.

No join is hinted (but for `plans.top_state.merged`, which counts its keys first): the planner decides by size. Plan-time broadcast below
`spark.sql.autoBroadcastJoinThreshold` (estimated size), AQE's runtime
switch to broadcast below `spark.sql.adaptive.autoBroadcastJoinThreshold`
(measured size), otherwise a shuffled join with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_calendar(df: DataFrame, day: Column, calendar: DataFrame) -> DataFrame:
    """Rows whose day appears in the calendar (inner join to a date dimension
    whose columns are never read, under a later DISTINCT/MAX/anti join)."""
    cal = calendar.select(F.col("cal_date").alias("_cal_date")).distinct()
    return df.join(cal, day == F.col("_cal_date"), "left_semi")


def exists_in(df: DataFrame, keys: DataFrame, left: str, right: str | None = None,
              keys_unique: bool = False, written: bool = False) -> DataFrame:
    """Semi join: keep rows of `df` whose `left` value occurs in `keys[right]`.

    The key side is de-duplicated first (partial aggregation, so a key repeated
    many times is collapsed before any shuffle) unless it is known to be unique.

    `written`: `keys` is a written slice with text keys, met by a history. If it is
    too large to broadcast, the history is pruned before its shuffle by a bloom
    filter of the keys; the planner builds one only from a scan with a selective
    predicate, so the slice gets one that is true of every key. No aggregate may
    stand between, so the keys aren't de-duplicated.
    """
    right = right or left
    k = keys.select(F.col(right).alias("_k"))
    if written:
        k = k.filter(F.col("_k") >= F.lit(""))
    elif not keys_unique:
        k = k.distinct()
    return df.join(k, F.col(left) == F.col("_k"), "left_semi")


def anti_keeping_null(df: DataFrame, keys: DataFrame, left: str, right: str | None = None) -> DataFrame:
    """Left anti join on equality: rows with a NULL key never match and are kept.

    (`NOT IN (subquery)` would instead return nothing once the subquery holds
    a NULL.)
    """
    right = right or left
    k = keys.select(F.col(right).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    return df.join(k, F.col(left) == F.col("_k"), "left_anti")


def left_join(df: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Left outer equi-join whose NULL-keyed rows, which can't match, stay out of the shuffle.

    Hashed, all of them would land in one partition however many they are.
    """
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    matched = df.filter(F.col(key).isNotNull()).join(right, F.col(key) == F.col(right_key), "left")
    return matched.unionByName(df.filter(F.col(key).isNull()).select("*", *absent))
