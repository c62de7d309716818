"""Hot keys: one key holding a third of all rows.

The per-key operators aggregate first (map-side partial aggregation) and join
back on an equi-join, so a hot key is split by AQE's skew handling instead of
landing in one task. Results are checked against brute-force window versions.
"""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chargewise.operators.dedup import suffix_duplicate_ids
from chargewise.operators.ranking import top_ties
from tests.conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def hot_status_rows(spark, n=300_000):
    # a third of the rows on line 'HOT', the rest spread over 2,000 lines
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("L"), (F.col("id") % 2000).cast("string")))
         .alias("line_key"),
        F.when(F.col("id") % 7 == 0, F.lit("9000")).otherwise(F.lit("3200")).alias("status"),
        F.col("id"))


def test_top_ties_hot_key_is_split_and_exact(spark, skew_conf):
    df = hot_status_rows(spark)
    top = top_ties(df, ["line_key"], "status")
    top.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        top.explain()   # after execution: the final adaptive plan
    assert "skew=true" in buf.getvalue()
    w = Window.partitionBy("line_key").orderBy(F.col("status").desc())
    brute = df.withColumn("r", F.dense_rank().over(w)).filter("r = 1").drop("r")
    assert top.count() == brute.count()
    assert top.exceptAll(brute).count() == 0


def test_duplicate_suffix_hot_group_of_copies(spark, monkeypatch):
    import chargewise.operators.dedup as dedup
    monkeypatch.setattr(dedup, "COPY_CHUNK", 1000)
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit("P")).otherwise(F.concat(F.lit("Q"), (F.col("id") % 500).cast("string")))
         .alias("PO_NUMBER"),
        F.when(F.col("id") < n // 3, F.lit(1.0)).otherwise(F.col("id").cast("double")).alias("amount"))
    out = suffix_duplicate_ids(df, "PO_NUMBER")
    counts = {(r.PO_NUMBER, r.amount): r.c for r in
              out.filter(F.col("PO_NUMBER").startswith("P")).groupBy("PO_NUMBER", "amount")
                 .agg(F.count(F.lit(1)).alias("c")).collect()}
    assert counts == {("P", 1.0): 1, ("P_dup", 1.0): n // 3 - 1}
    w = Window.partitionBy("PO_NUMBER").orderBy(F.col("amount").asc_nulls_first())
    brute = (df.withColumn("_r", F.row_number().over(w))
               .withColumn("PO_NUMBER", F.when(F.col("_r") == 1, F.col("PO_NUMBER"))
                           .otherwise(F.concat("PO_NUMBER", F.lit("_dup")))).drop("_r"))
    assert out.count() == n
    assert rows(out.filter(~F.col("PO_NUMBER").startswith("P"))) == rows(brute.filter(~F.col("PO_NUMBER").startswith("P")))


def test_latest_cancel_hot_line_is_split_and_exact(spark, skew_conf):
    from chargewise.operators.ranking import latest_with_total
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("L"), (F.col("id") % 2000).cast("string")))
         .alias("line_key"),
        # the hot line's latest time is shared by many rows (ties kept)
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(F.col("id") % 11)).alias("ts"),
        (F.col("id") % 4).cast("decimal(18,2)").alias("qty"),
        F.col("id"))
    out = latest_with_total(df, "line_key", "ts", "qty", "total")
    out.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "skew=true" in buf.getvalue()
    w = Window.partitionBy("line_key")
    brute = (df.withColumn("m", F.max("ts").over(w)).withColumn("total", F.sum("qty").over(w))
               .filter(F.col("ts") == F.col("m")).drop("m", "qty"))
    assert out.count() == brute.count()
    assert out.select(*brute.columns).exceptAll(brute).count() == 0
