"""Duplicate-id suffixing.

For each id the first row (ordered by all other columns, NULLs first)
keeps the id; every other row of that id gets `id + '_dup'`. A NULL id
stays NULL. Identical rows are interchangeable, so "first" is well defined
as a multiset.

The computation never gathers one id's rows in one task:
  1. count identical rows (partial aggregation),
  2. per id, the smallest remaining-columns struct (partial aggregation),
  3. join back on id (AQE splits a skewed id's partition),
  4. emit each distinct row as (id, 1 if first) and (id_dup, count - that),
  5. repeat rows by their count in bounded chunks spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest number of copies one generator call emits; larger counts are split
# into chunks that are spread over tasks before expansion.
COPY_CHUNK = 100_000


def repeat_rows(df: DataFrame, count: str, partitions: int | None = None) -> DataFrame:
    """Emit each row `count` times (count >= 1), without one huge array or task.

    Only rows with more copies than one chunk are dealt over tasks before they are repeated.
    """
    cols = [c for c in df.columns if c != count]
    n = F.col(count)
    few = (df.filter(n <= COPY_CHUNK).select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("_i")).drop("_i"))
    chunks = df.filter(n > COPY_CHUNK).select(*cols, n, F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.floor((n - 1) / COPY_CHUNK).cast("long"))).alias("_chunk"))
    chunks = chunks.withColumn("_len", F.least(F.lit(COPY_CHUNK).cast("long"),
                                               n - F.col("_chunk") * COPY_CHUNK))
    spread = chunks.repartition(partitions, *cols, "_chunk") if partitions else chunks.repartition(*cols, "_chunk")
    many = spread.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_len"))).alias("_i")).drop("_i")
    return few.unionByName(many)


def suffix_duplicate_ids(df: DataFrame, id_col: str, suffix: str = "_dup",
                         rows_distinct: bool = False) -> DataFrame:
    """`rows_distinct=True` when no two rows are identical (e.g. after a set union):
    every row then has one copy, and steps 1 and 5 are skipped."""
    cols = list(df.columns)
    rest = [c for c in cols if c != id_col]
    if rows_distinct:
        keyed = df.filter(F.col(id_col).isNotNull())
        order = F.struct(*(F.col(c) for c in rest)) if rest else F.lit(0)
        first = keyed.groupBy(F.col(id_col).alias("_fid")).agg(F.min(order).alias("_first"))
        own = F.when(order.eqNullSafe(F.col("_first")), F.col(id_col)).otherwise(F.concat(F.col(id_col), F.lit(suffix)))
        named = keyed.join(first, keyed[id_col] == first["_fid"]).select(own.alias(id_col), *rest)
        return named.unionByName(df.filter(F.col(id_col).isNull()).select(id_col, *rest)).select(*cols)

    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    null_ids = counted.filter(F.col(id_col).isNull())
    keyed = counted.filter(F.col(id_col).isNotNull())
    order = F.struct(*(F.col(c) for c in rest)) if rest else F.lit(0)
    first = keyed.groupBy(F.col(id_col).alias("_fid")).agg(F.min(order).alias("_first"))
    joined = keyed.join(first, keyed[id_col] == first["_fid"], "inner")
    is_first = F.when(order.eqNullSafe(F.col("_first")), F.lit(1)).otherwise(F.lit(0)).cast("long")
    parts = F.array(
        F.struct(F.col(id_col).alias("_id"), is_first.alias("_m")),
        F.struct(F.concat(F.col(id_col), F.lit(suffix)).alias("_id"), (F.col("_n") - is_first).alias("_m")),
    )
    labelled = (joined.select(*rest, F.explode(parts).alias("_p"))
                      .select(F.col("_p._id").alias(id_col), *rest, F.col("_p._m").alias("_n"))
                      .filter(F.col("_n") > 0))
    both = labelled.unionByName(null_ids.select(id_col, *rest, "_n"))
    return repeat_rows(both, "_n").select(*cols)
