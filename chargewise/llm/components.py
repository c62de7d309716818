"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a groupBy (partial minimum before the shuffle) and an equi-join whose hot keys the
adaptive planner splits; no neighbour list is gathered. Each round is written to the shared scratch
folder, so a lost executor repeats one round at most. The driver sees one count and one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargewise.llm.common import written


def _larger_first(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links between long ids -> (node, root) for every node other than its component's least id.

    Self links and repeated links are allowed; an empty table gives an empty table.
    """
    now = written(_larger_first(edges), "components")
    state = _state(now)
    while True:
        now = written(_larger_first(_small_star(_larger_first(_large_star(now)))), "components")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
