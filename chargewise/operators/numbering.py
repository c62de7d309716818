"""Row numbers that depend on the rows alone, not on how they are partitioned.

Rows are numbered from 1 in the order of all their columns (NULLs first). They are range-partitioned and sorted,
numbered within their partition, and moved up by the sizes of the partitions before it; no task sees more than its own
range. Equal rows get successive numbers; a row that repeats is one row with a count until the end, so
no partition holds its copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargewise.operators.dedup import COPY_CHUNK
from chargewise.operators.working_set import materialize


def number_rows(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """`df` with the column `name` (long): 1, 2, .. in order of all columns. The sizes of the partitions (one
    number each) pass through the driver."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    order = [c.asc_nulls_first() for c in columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = counted.repartitionByRange(partitions, *order) if partitions else counted.repartitionByRange(*order)
    # Written: the partition and the place within it must not change when a lost task is run again.
    placed = materialize(ranged.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    sizes = placed.groupBy("_part").agg(F.sum("_copies").alias("n")).collect()
    before, starts = 0, []
    for r in sorted(sizes, key=lambda r: r["_part"]):
        starts.append((r["_part"], before))
        before += r["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    so_far = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("_before") + F.sum("_copies").over(so_far)
    first = placed.join(offsets, "_part").select(*columns, "_copies", (last - F.col("_copies") + 1).alias("_first"))
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPY_CHUNK).cast("long"))
    cut = first.select("*", F.explode(chunks).alias("_chunk"))
    few, many = cut.filter(F.col("_copies") <= COPY_CHUNK), cut.filter(F.col("_copies") > COPY_CHUNK).repartition("_first", "_chunk")
    lo = F.col("_first") + F.col("_chunk") * COPY_CHUNK
    hi = F.least(lo + COPY_CHUNK, F.col("_first") + F.col("_copies")) - 1
    return few.unionByName(many).select(*columns, F.explode(F.sequence(lo, hi)).alias(name))
