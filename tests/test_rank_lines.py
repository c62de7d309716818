"""Whole histories ranked line by line: against ranking by joins, with hot lines, and what is shuffled and written on the way."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from chargewise import catalog_queries as CQ
from chargewise.plans import rule_710
from tests.conftest import SF_ORACLE, rows
from tests.test_rules import base_710, line, make_inputs
from tools.plans import plan_text

DAY0 = dt.datetime(2025, 1, 5)


def odd_inputs(spark, seed, n=400):
    """Rows without line, order, time, schedule or status; lines and orders that repeat, are undated or aren't known."""
    rng = random.Random(seed)
    history = [(f"k{i}", "r", rng.choice([None, "HOT", "HOT", *(f"L{j}" for j in range(12))]), rng.choice([None, "O0", "O0", "O1", "O2", "C1", "?"]),
                rng.choice([None, "1", "2"]), rng.choice([None, "1100", "3200", "9000", "9999"]),
                rng.choice([None, *(DAY0 + dt.timedelta(days=d) for d in range(5))]), D("1.00")) for i in range(n)]
    lines = [line(key, "O0", item=item) for key, item in [("HOT", 1), *((f"L{j}", j) for j in range(10)), ("L1", 50), ("L2", 60), ("L3", 3)]]
    undated = DAY0 + dt.timedelta(days=900)
    lines = [(*r[:9], undated if i in (2, 6, 12) else (None if i == 7 else DAY0), *r[10:]) for i, r in enumerate(lines)]
    orders = [("O0", "PO-0", DAY0, "0005"), ("O1", "PO-1", DAY0, "0005"), ("O1", "PO-1b", DAY0, "0005"), ("C1", "SO-1", DAY0, "0001")]
    statuses = base_710()["status_dim"] + [("3200", "Released again", "PO_FULFILLMENT"), ("9999", "Other", "ORDER_FULFILLMENT")]
    return make_inputs(spark, rel_status=history, oms_line=lines, oms_order=orders, status_dim=statuses, time_dim=[(DAY0.date(),), (DAY0.date(),)])


@pytest.mark.parametrize("seed,hot_rows", [(1, 10**6), (2, 10**6), (3, 40), (4, 0)])
def test_lines_ranked_in_windows_equal_ranking_by_joins(spark, monkeypatch, seed, hot_rows):
    monkeypatch.setattr(rule_710, "HOT_ROWS", hot_rows)
    inputs = odd_inputs(spark, seed)
    want = rule_710.rank_top_status(inputs, rule_710.with_line_and_order(inputs, inputs["rel_status"]))
    got = rule_710.top_status(inputs)
    assert got.columns == want.columns and want.count() > 20
    assert rows(got) == rows(want)
    assert rows(rule_710.top_status_of(inputs, inputs["rel_status"])) == rows(want)


def test_a_hot_line_is_not_ranked_in_a_window(spark, monkeypatch):
    """A line with more rows than a task should take goes through the joins, which share it among tasks."""
    monkeypatch.setattr(rule_710, "HOT_ROWS", 40)
    inputs, windowed, joined = odd_inputs(spark, 5), [], []
    windows, joins = rule_710._rank_in_windows, rule_710.rank_top_status
    monkeypatch.setattr(rule_710, "_rank_in_windows", lambda i, r: windowed.append(r) or windows(i, r))
    monkeypatch.setattr(rule_710, "rank_top_status", lambda i, r: joined.append(r) or joins(i, r))
    rule_710.top_status(inputs).collect()
    keys = [{r[0] for r in frames[0].select("line_key").distinct().collect()} for frames in (windowed, joined)]
    assert "HOT" not in keys[0] and "L1" in keys[0]
    assert keys[1] == {"HOT"}


def test_the_whole_history_is_shuffled_twice_and_not_written(spark, monkeypatch):
    """Once to its orders, once to its lines, where it is ranked: no copy, no further exchange."""
    inputs = CQ.inputs_for(spark, SF_ORACLE)
    written = []
    original = rule_710.materialize
    monkeypatch.setattr(rule_710, "materialize", lambda df: written.append(df) or original(df))
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k in limits:
            spark.conf.set(k, "64KB")         # dimensions are broadcast, histories are not: as with large tables
        plan = plan_text(rule_710.top_status_report(inputs))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert not written
    exchanges = [line.split("Exchange hashpartitioning(")[1].split("#")[0] for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    assert sorted(exchanges) == ["_cal_date", "_ol_line", "_ord_key", "line_key", "order_key"], exchanges


def test_tasks_of_compressed_histories_are_small(spark):
    """128 MB of keys in zstd are millions of rows, which a task would sort on disk."""
    CQ.inputs_for(spark, SF_ORACLE)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        assert size(spark.conf.get(key)) <= 32 << 20, key
