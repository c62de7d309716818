"""One query per operator family, run on the plain test tables.

Each exercises a rule building block (its NULL, tie or duplicate behaviour)
over whole tables, so it can be checked against independently written SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargewise.functions import dates, text
from chargewise.operators import joins, predicates as pred
from chargewise.operators.dedup import suffix_duplicate_ids
from chargewise.operators.numbering import number_rows
from chargewise.session import tune
from chargewise.operators.union import aligned_union

MONEY = "decimal(18,2)"
WEEK_AS_OF = dt.date(2024, 1, 29)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def not_in_or(spark, sf_dir) -> DataFrame:
    """`a NOT IN (..) OR b NOT IN (..)` over two left-joined, nullable sides."""
    li = _t(spark, sf_dir, "lineitem").select("l_returnflag", "l_partkey", "l_suppkey")
    part = _t(spark, sf_dir, "part").filter(F.col("p_size") < 25).select("p_partkey", "p_type")
    supp = _t(spark, sf_dir, "supplier").filter(F.col("s_nationkey") < 12).select("s_suppkey", "s_nationkey")
    rows = (li.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
              .join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "left")
              .filter(pred.outside_either(F.col("p_type"), ("ECONOMY", "SMALL"),
                                          F.col("s_nationkey").cast("string"), ("1", "2", "3"))))
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


def null_tolerant_exclusion(spark, sf_dir) -> DataFrame:
    """F9 (`<>` drops NULL), F10 (`NOT IN .. OR IS NULL` keeps it), F11 (`NOT IN` drops it)."""
    o = _t(spark, sf_dir, "orders")
    prio = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority"))
    listed = ("1-URGENT", "2-HIGH")
    return o.groupBy("o_orderstatus").agg(
        F.count(F.when(pred.differs_dropping_null(prio, "1-URGENT"), 1)).alias("n_differs"),
        F.count(F.when(pred.not_in_keeping_null(prio, listed), 1)).alias("n_not_in_keep_null"),
        F.count(F.when(pred.not_in_dropping_null(prio, listed), 1)).alias("n_not_in_drop_null"))


def left_anti_null(spark, sf_dir) -> DataFrame:
    """J14: left anti join keeps rows whose key is NULL, even when the other side has NULLs."""
    def key(c):
        return F.when(F.col(c) % 50 == 0, F.lit(None)).otherwise(F.col(c))
    exempt = _t(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_custkey")).alias("k"))
    rows = _t(spark, sf_dir, "orders").select("o_orderstatus", key("o_custkey").alias("k"))
    kept = joins.anti_keeping_null(rows, exempt, "k")
    return kept.groupBy("o_orderstatus", F.col("k").isNull().alias("null_key")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def distinct_wide_narrow(spark, sf_dir) -> DataFrame:
    """A1: DISTINCT over wide keys, then a narrower projection without a second DISTINCT."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_returnflag").distinct().select("l_orderkey", "l_returnflag")


def sum_null_parts(spark, sf_dir) -> DataFrame:
    """A2: single sums skip NULL parts; the sum of `q + t` skips whole rows."""
    li = _t(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast(MONEY)
    t = F.when(F.col("l_tax") == 0.08, F.lit(None)).otherwise(F.col("l_tax")).cast(MONEY)
    return li.groupBy("l_suppkey").agg(
        F.sum(q).cast(MONEY).alias("sum_qty"), F.sum(t).cast(MONEY).alias("sum_tax"),
        F.sum(q + t).cast(MONEY).alias("sum_total"))


def week_window(spark, sf_dir) -> DataFrame:
    """X12 + F5: events in the last full Sunday-Saturday week before the run date."""
    start, end = dates.previous_week(WEEK_AS_OF)
    ev = _t(spark, sf_dir, "events").filter(dates.ts_within(F.col("ts"), start, end))
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("value").cast(MONEY)).cast("decimal(18,2)").alias("sum_value"),
        F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"))


def comment_builder(spark, sf_dir) -> DataFrame:
    """P7/X1/X2/X4: the three comment templates and the yyyyMMdd stamp, NULL inputs included."""
    o = _t(spark, sf_dir, "orders")
    trk = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderkey"))
    day = F.to_date("o_orderdate")
    cancel = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.date_add(day, 3))
    return o.select(
        "o_orderkey",
        text.comment_702(trk).alias("c702"),
        text.comment_706(trk).alias("c706"),
        text.comment_710(day, cancel).alias("c710"),
        F.date_format(day, "yyyyMMdd").alias("stamp"))


def dup_suffix(spark, sf_dir) -> DataFrame:
    """W2/W3: first row per id (ordered by all other columns, NULLs first) keeps the id."""
    o = _t(spark, sf_dir, "orders")
    rid = F.when(F.col("o_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string"))
    rows = o.select(rid.alias("ROW_ID"), "o_orderstatus", "o_orderpriority",
                    (F.col("o_orderkey") % 3).alias("bucket"))
    return suffix_duplicate_ids(rows, "ROW_ID")


def row_numbers(spark, sf_dir) -> DataFrame:
    """W4: rows, some repeated, some with NULLs, numbered in the order of all their columns."""
    li = _t(spark, sf_dir, "lineitem")
    rows = li.select("l_returnflag", F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("line"),
                     (F.col("l_suppkey") % 10).alias("bucket"), F.to_date("l_shipdate").alias("day"))
    tune(spark)
    return number_rows(rows, "ROW_ID")


def aligned_union_q(spark, sf_dir) -> DataFrame:
    """P5/U1: union over the sorted column superset, each column in the type that holds both sides exactly;
    duplicates removed across inputs. ID is text with leading zeros on one side and a number on the other."""
    a = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("NATIONKEY"), F.col("c_mktsegment").alias("SEGMENT"),
                                             F.lpad((F.col("c_custkey") % 100).cast("string"), 3, "0").alias("ID"),
                                             F.col("c_acctbal").cast("decimal(12,2)").alias("AMOUNT"))
    b = _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 3).cast("string").alias("BUCKET"),
                                             F.col("s_nationkey").alias("NATIONKEY"), F.col("s_suppkey").alias("ID"),
                                             (F.col("s_suppkey") % 5).cast("int").alias("AMOUNT"))
    return aligned_union([a, b])


def case_flag(spark, sf_dir) -> DataFrame:
    """X8/F13: 'Y' if the code is listed or the text holds a listed fragment, else 'N'."""
    p = _t(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(F.col("p_name"))
    flag = text.exemption_flag(F.col("p_type"), name, ("ECONOMY", "PROMO"), ("ring", "gear"))
    return p.select("p_partkey", flag.alias("flag"))

