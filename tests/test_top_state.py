"""The weekly top-status state against ranking the whole history; bucketed histories without shuffles."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from chargewise import catalog_queries as CQ
from chargewise import jobs, schemas
from chargewise.operators.working_set import materialize
from chargewise.plans import rule_710, top_state
from chargewise.sources import layout
from tests.conftest import SF_ORACLE, rows
from tests.test_rules import base_710, make_inputs
from tools.plans import plan_text

DAY0 = dt.datetime(2025, 1, 5)


def history(rng, n, days=40):
    """Status rows with ties in time and status, several schedules and orders per line."""
    return [(f"k{i}", "r", f"L{rng.randrange(12)}", f"O{rng.randrange(2)}", str(rng.randrange(3)), rng.choice(["1100", "3200", "9000"]),
             DAY0 + dt.timedelta(days=rng.randrange(days), hours=rng.choice([0, 12])), D("1.00")) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, schemas.INPUTS["rel_status"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_weekly_merges_equal_the_whole_history(spark, seed):
    rng = random.Random(seed)
    data = history(rng, 150)
    cuts = [DAY0 + dt.timedelta(days=d) for d in (0, 10, 17, 24, 40)]
    state = None
    for lo, hi in zip(cuts, cuts[1:]):
        known = [r for r in data if r[6] < hi]
        week = frame(spark, [r for r in known if r[6] >= lo])
        state = materialize(top_state.competing(week) if state is None else
                            top_state.merged(state, week, frame(spark, known).filter("raise_error('history was read') is null")))
        assert rows(state) == rows(top_state.competing(frame(spark, known)))
    assert state.count() < len(data)


def test_late_and_repeated_weeks(spark):
    rng = random.Random(9)
    data = history(rng, 120)
    late = [r for r in data if rng.random() < 0.15]
    first = [r for r in data if r not in late]
    state = materialize(top_state.competing(frame(spark, first)))
    whole = frame(spark, data)
    state = materialize(top_state.merged(state, frame(spark, late), whole))
    assert rows(state) == rows(top_state.competing(whole))
    again = top_state.merged(state, frame(spark, data[-40:]), whole)
    assert rows(again) == rows(state)
    assert rows(top_state.merged(state, frame(spark, []), whole)) == rows(state)
    assert rows(top_state.merged(state.limit(0), whole, whole)) == rows(state)


def test_a_schedule_that_joins_another_at_an_old_time(spark):
    """A late row of a new schedule makes a superseded row of its line compete again."""
    t = [DAY0 + dt.timedelta(days=i) for i in range(3)]
    old = [("a", "r", "L", "O", "1", "9000", t[0], D(1)), ("b", "r", "L", "O", "1", "1100", t[1], D(1))]
    late = [("c", "r", "L", "O", "2", "1100", t[0], D(1))]
    state = top_state.merged(materialize(top_state.competing(frame(spark, old))), frame(spark, late), frame(spark, old + late))
    assert rows(state, "status_key") == [("a",), ("b",), ("c",)]


def test_the_job_keeps_the_state(spark):
    inputs = make_inputs(spark, **base_710())
    times = [r[0] for r in rows(inputs["rel_status"], "status_ts")]
    monday = max(times).date() + dt.timedelta(days=10)
    monday += dt.timedelta(days=(0 - monday.weekday()) % 7)
    for _ in range(2):                      # the second run merges an empty week
        state = jobs.run_top_state(spark, inputs, monday, table="T_TOP_STATE")
        monday += dt.timedelta(days=7)
    assert rows(rule_710.top_status_of(inputs, state)) == rows(rule_710.top_status(inputs))
    spark.sql("DROP TABLE T_TOP_STATE")


def test_bucketed_histories_are_not_shuffled(spark):
    """Whole-history reports over bucketed tables: the same rows, and no exchange between a history and its joins and aggregates."""
    inputs = CQ.inputs_for(spark, SF_ORACLE)
    before = {k: spark.conf.get(k) for k in layout.LAYOUT_CONF}
    limits = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    tables = {r: f"t_buckets_{r}" for r in layout.BUCKET_KEYS}
    reports = {"latest_cancel": rule_710.latest_cancel, "unit_cost": rule_710.unit_cost,
               "competing": lambda i: top_state.competing(i["rel_status"])}
    want = {n: rows(f(inputs)) for n, f in reports.items()}
    try:
        for relation, table in tables.items():
            layout.write_buckets(inputs[relation], relation, table, 6)
        bucketed = layout.with_buckets(inputs, tables, spark)
        assert rows(rule_710.top_status(bucketed)) == rows(rule_710.top_status(inputs))
        # Dimensions are broadcast, histories are not: as with production sizes.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64KB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64KB")
        for name, report in reports.items():
            df = report(bucketed)
            assert rows(df) == want[name]
            shuffled = [line for line in plan_text(df).split("\n") if "Exchange hashpartitioning" in line]
            for key in layout.BUCKET_KEYS.values():
                assert not [line for line in shuffled if key in line or "_lt_k" in line or "_line" in line], (name, shuffled)
            assert "Bucketed: true" in plan_text(df)
    finally:
        for k, v in {**before, **limits}.items():
            spark.conf.set(k, v)
        for table in tables.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_competing_shuffles_a_history_once(spark):
    rows_ = CQ.inputs_for(spark, SF_ORACLE)["rel_status"]
    assert plan_text(top_state.competing(rows_)).count("Exchange hashpartitioning") == 1


def test_a_week_neither_copies_nor_shuffles_the_state(spark, monkeypatch):
    rng = random.Random(4)
    data = history(rng, 150)
    cut = DAY0 + dt.timedelta(days=30)
    state = materialize(top_state.competing(frame(spark, [r for r in data if r[6] < cut])))
    written = []
    monkeypatch.setattr(top_state, "materialize", lambda df: written.append(materialize(df)) or written[-1])
    week = frame(spark, [r for r in data if r[6] >= cut and r[2] in ("L1", "L2")])
    result = top_state.merged(state, week, frame(spark, data))
    assert "Exchange hashpartitioning" not in plan_text(result)
    assert {r[0] for r in rows(written[-1], "line_key")} == {"L1", "L2"}
    known = [r for r in data if r[6] < cut or r[2] in ("L1", "L2")]
    assert rows(result) == rows(top_state.competing(frame(spark, known)))


@pytest.mark.parametrize("few, hot", [(0, 100_000), (500_000, 3), (0, 3)])
def test_large_windows_and_hot_lines_give_the_same_state(spark, monkeypatch, few, hot):
    monkeypatch.setattr(top_state, "FEW_LINES", few)
    monkeypatch.setattr(rule_710, "HOT_ROWS", hot)
    data = history(random.Random(6), 120) + [("n", "r", None, "O", "1", "9000", DAY0, D(1)), ("m", "r", "L3", None, None, "9000", None, D(1))]
    cut = DAY0 + dt.timedelta(days=25)
    old, new = [r for r in data if r[6] is None or r[6] < cut], [r for r in data if r[6] and r[6] >= cut]
    state = top_state.merged(materialize(top_state.competing(frame(spark, old))), frame(spark, new), frame(spark, data))
    last = {}
    for r in data:
        if r[6]:
            last[r[2:5]] = max(last.get(r[2:5], r[6]), r[6])
    times = {(k[0], t) for k, t in last.items() if k[0] is not None}
    assert rows(state) == sorted((r for r in data if (r[2], r[6]) in times), key=lambda t: tuple((v is not None, v) for v in t))
