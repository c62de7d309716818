"""Keep-the-top-rows operators with ties kept.

Both are written as "aggregate per key, then join back on (key, value)":
the aggregate runs partial on the map side, so a key holding a large share
of the rows never gathers in one task, and the join back is an equi-join
on which AQE can split a skewed partition. Row sets equal
`dense_rank() OVER (PARTITION BY key ORDER BY value DESC) = 1` for
non-NULL values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_ties(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows whose `value` equals the greatest `value` of their key (all ties)."""
    renamed = [f"_top_k{i}" for i in range(len(keys))]
    best = (df.groupBy(*(F.col(k).alias(r) for k, r in zip(keys, renamed)))
              .agg(F.max(value).alias("_top_v")))
    cond = [F.col(k) == F.col(r) for k, r in zip(keys, renamed)] + [F.col(value) == F.col("_top_v")]
    return df.join(best, cond, "inner").select(*df.columns)


def latest_with_total(df: DataFrame, key: str, ts: str, qty: str,
                      total_alias: str) -> DataFrame:
    """Rows at their key's latest timestamp, each carrying the key's total qty.

    A NULL timestamp never equals the maximum, so such rows drop out, as in
    the join-back form of the source query.
    """
    agg = df.groupBy(F.col(key).alias("_lt_k")).agg(F.max(ts).alias("_lt_ts"),
                                                    F.sum(qty).alias(total_alias))
    joined = df.join(agg, (F.col(key) == F.col("_lt_k")) & (F.col(ts) == F.col("_lt_ts")), "inner")
    return joined.select(*(c for c in df.columns if c != qty), total_alias)
