"""Operator unit tests on hand-made rows (FIXTURES.md section 3)."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chargewise.functions import dates, text
from chargewise.operators import joins, predicates as pred
from chargewise.operators.dedup import repeat_rows, suffix_duplicate_ids
from chargewise.operators.ranking import latest_with_total, top_ties
from chargewise.operators.union import aligned_union
from chargewise.plans.combine import combine_frames, parse_rule_list
from tests.conftest import rows


def test_outside_either_three_valued(spark):
    df = spark.createDataFrame(
        [(1, "ground", None), (2, "2Day", None), (3, None, "2"), (4, None, "9"), (5, None, None), (6, "ground", "9")],
        "id int, svc string, zone string")
    kept = df.filter(pred.outside_either(F.col("svc"), ["ground"], F.col("zone"), ["2"]))
    assert [r.id for r in kept.orderBy("id").collect()] == [2, 4, 6]


def test_zone_codes_are_strings(spark):
    df = spark.createDataFrame([("02",), ("002",), ("2",)], "zone string")
    kept = df.filter(pred.outside_either(F.lit(None).cast("string"), ["x"], F.col("zone"), ["2", "002"]))
    assert rows(kept) == [("02",)]


def test_null_dropping_and_keeping_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(df.filter(pred.not_in_dropping_null(F.col("v"), ["a"]))) == [("b",)]
    assert rows(df.filter(pred.differs_dropping_null(F.col("v"), "a"))) == [("b",)]
    assert rows(df.filter(pred.not_in_keeping_null(F.col("v"), ["a"]))) == [(None,), ("b",)]


def test_anti_join_keeps_null_keys(spark):
    left = spark.createDataFrame([("p1",), ("p2",), (None,)], "po string")
    right = spark.createDataFrame([("p1",), (None,)], "po string")
    assert rows(joins.anti_keeping_null(left, right, "po")) == [(None,), ("p2",)]


def test_top_ties_keeps_all_ties(spark):
    df = spark.createDataFrame(
        [("L1", "9000", 1), ("L1", "9000", 2), ("L1", "3200", 3), ("L2", "1100", 4)],
        "line string, status string, id int")
    assert [r.id for r in top_ties(df, ["line"], "status").orderBy("id").collect()] == [1, 2, 4]


def test_top_ties_equals_dense_rank(spark):
    random.seed(7)
    data = [(f"L{random.randint(0, 30)}", str(random.choice([1100, 3200, 9000])), i) for i in range(400)]
    df = spark.createDataFrame(data, "line string, status string, id int")
    w = Window.partitionBy("line").orderBy(F.col("status").desc())
    ranked = df.withColumn("r", F.dense_rank().over(w)).filter("r = 1").drop("r")
    assert rows(top_ties(df, ["line"], "status")) == rows(ranked)


def test_latest_with_total_ties_and_null_ts(spark):
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    df = spark.createDataFrame(
        [("L1", t1, Decimal("1"), "a"), ("L1", t2, Decimal("2"), "b"), ("L1", t2, Decimal("3"), "c"),
         ("L2", None, Decimal("5"), "d")],
        "line string, ts timestamp, qty decimal(18,2), code string")
    out = latest_with_total(df, "line", "ts", "qty", "total")
    assert rows(out, "line", "code", "total") == [("L1", "b", Decimal("6.00")), ("L1", "c", Decimal("6.00"))]


def test_previous_week():
    assert dates.previous_week(dt.date(2025, 8, 2)) == (dt.date(2025, 7, 20), dt.date(2025, 7, 26))
    assert dates.previous_week(dt.date(2025, 8, 3)) == (dt.date(2025, 7, 27), dt.date(2025, 8, 2))
    assert dates.previous_week(dt.date(2025, 8, 4)) == (dt.date(2025, 7, 27), dt.date(2025, 8, 2))


def test_previous_week_column_form_matches(spark):
    days = [dt.date(2025, 7, 28) + dt.timedelta(days=i) for i in range(14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    s, e = dates.previous_week_col(F.col("d"))
    got = {r.d: (r.s, r.e) for r in df.select("d", s.alias("s"), e.alias("e")).collect()}
    assert got == {d: dates.previous_week(d) for d in days}


def test_ts_within_is_inclusive_by_day(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 4, 23, 59),), (dt.datetime(2025, 1, 5, 0, 0),), (dt.datetime(2025, 1, 3, 23, 59),)],
        "ts timestamp_ntz")
    kept = df.filter(dates.ts_within(F.col("ts"), dt.date(2025, 1, 4), dt.date(2025, 1, 4)))
    assert rows(kept) == [(dt.datetime(2025, 1, 4, 23, 59),)]


def test_comments_null_behaviour(spark):
    df = spark.createDataFrame([("T1", dt.date(2025, 1, 2)), (None, None)], "trk string, d date")
    out = df.select(text.comment_702(F.col("trk")).alias("c2"), text.comment_706(F.col("trk")).alias("c6"),
                    text.comment_710(F.col("d"), F.col("d")).alias("c10")).collect()
    by = {r.c2.split(" ")[2]: r for r in out}
    assert by["T1"].c6.startswith("PRO: T1 Vendor must include")
    assert by["T1"].c10 == "Order Date: 2025-01-02;Cancellation Date: 2025-01-02;"
    empty = [r for r in out if r.c6 is None][0]
    assert empty.c2.startswith("DMC702 Tracking:  Vendor expedited") and empty.c10 is None


def test_exemption_flag(spark):
    df = spark.createDataFrame(
        [("PO Not Received", None), (None, "x Closed for Federal Holiday y"), ("Other", "hello"), (None, None)],
        "code string, txt string")
    flag = text.exemption_flag(F.col("code"), F.col("txt"), ["PO Not Received"], ["Closed for Federal Holiday"])
    assert [r.f for r in df.select(flag.alias("f")).collect()] == ["Y", "Y", "N", "N"]


def test_aligned_union_distinct_only_with_two_inputs(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1)], "A string, B int")
    b = spark.createDataFrame([(1, "x", "z")], "B int, A string, C string")
    assert aligned_union([a]).count() == 2
    both = aligned_union([a, b])
    assert both.columns == ["A", "B", "C"]
    assert rows(both) == [("x", 1, None), ("x", 1, "z")]


def test_superset_holds_both_anchor_columns(spark):
    f706 = spark.createDataFrame([("p", "x")], "PO_NUMBER string, ANCHOR_CONST string")
    f710 = spark.createDataFrame([("q", "x")], "PO_NUMBER string, ANCHOR_CONSTANT string")
    res = combine_frames({"706": f706, "710": f710}, "706,710")
    assert res.frame.columns == ["ANCHOR_CONST", "ANCHOR_CONSTANT", "PO_NUMBER"]


def test_duplicate_suffix(spark):
    df = spark.createDataFrame([("p", 1), ("p", 2), ("p", 3), (None, 4), (None, 5)], "ID string, v int")
    assert rows(suffix_duplicate_ids(df, "ID")) == [(None, 4), (None, 5), ("p", 1), ("p_dup", 2), ("p_dup", 3)]


def test_duplicate_suffix_identical_rows(spark):
    df = spark.createDataFrame([("p", 1), ("p", 1), ("p", 0)], "ID string, v int")
    assert rows(suffix_duplicate_ids(df, "ID")) == [("p", 0), ("p_dup", 1), ("p_dup", 1)]


def test_duplicate_suffix_matches_window_brute_force(spark):
    random.seed(11)
    data = [(random.choice(["a", "b", "c", None]), random.choice([None, "x", "y"]), random.randint(0, 3))
            for _ in range(300)]
    df = spark.createDataFrame(data, "ID string, s string, n int")
    w = Window.partitionBy("ID").orderBy(F.col("s").asc_nulls_first(), F.col("n").asc_nulls_first())
    brute = (df.withColumn("_r", F.row_number().over(w))
               .withColumn("ID", F.when(F.col("_r") == 1, F.col("ID")).otherwise(F.concat("ID", F.lit("_dup"))))
               .drop("_r"))
    assert rows(suffix_duplicate_ids(df, "ID")) == rows(brute)


def test_repeat_rows_beyond_one_chunk(spark, monkeypatch):
    import chargewise.operators.dedup as dedup
    monkeypatch.setattr(dedup, "COPY_CHUNK", 7)
    df = spark.createDataFrame([("a", 23), ("b", 1), ("c", 7)], "k string, n long")
    out = repeat_rows(df, "n")
    assert {r.k: r.c for r in out.groupBy("k").agg(F.count(F.lit(1)).alias("c")).collect()} == {"a": 23, "b": 1, "c": 7}


def test_rule_list_parsing():
    assert parse_rule_list(" 702 ,, 710 ") == ["702", "710"]
    with pytest.raises(ValueError):
        parse_rule_list("")


def test_combine_reports_skipped_and_fails_when_none(spark):
    f = spark.createDataFrame([("p", 1.0)], "PO_NUMBER string, CHARGEBACK_AMOUNT double")
    res = combine_frames({"702": f, "999": None}, "702,999")
    assert res.merged == ["702"] and res.skipped == ["999"]
    assert "no feed for 999" in res.status()
    with pytest.raises(RuntimeError):
        combine_frames({"999": None}, "999")


def test_combine_generates_row_id_without_id_columns(spark):
    f = spark.createDataFrame([(1.0,), (1.0,)], "CHARGEBACK_AMOUNT double")
    out = combine_frames({"702": f}, "702").frame
    ids = [r.ROW_ID for r in out.collect()]
    assert len(ids) == 2 and len(set(ids)) == 2
