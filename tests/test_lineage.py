"""The lines behind rule 710's charges, and working sets that expire."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest

from chargewise import jobs
from chargewise import params as P
from chargewise.operators import working_set
from chargewise.plans import rule_710
from chargewise.session import ensure_checkpoint_dir
from tests.conftest import rows
from tests.test_rules import DAY, TS, WEEK, base_710, line, make_inputs, status

MONDAY = DAY + dt.timedelta(days=(7 - DAY.weekday()) % 7)


def po_line(n, **over):
    return [line(f"PL{n}", "PO1", "C1", f"CL{n}", **{"item": 7, **over}), line(f"CL{n}", "C1", item=7)]


def statuses(n):
    return [status(f"PL{n}", "PO1", "1", code, TS + dt.timedelta(days=d)) for d, code in enumerate(("1100", "3200", "9000"))]


def traced(spark, p=P.Rule710Params(), **over):
    inputs = make_inputs(spark, **base_710(**over))
    lineage = rule_710.rule_710_lineage(inputs, *WEEK, p)
    feed = {(r.PO_NUMBER, r.AUDIT_COMMENTS): r.CHARGEBACK_AMOUNT for r in rule_710.run_rule_710(inputs, *WEEK, DAY, p).collect()}
    summed = {}
    for r in lineage.collect():
        if r.REASON == rule_710.CHARGED:
            key = (r.PO_NUMBER, r.AUDIT_COMMENTS)
            summed[key] = summed.get(key, D(0)) + r.CHARGE
    assert {k: float(v) for k, v in summed.items()} == feed          # the lines add up to the feed exactly
    return rows(lineage, "LINE_KEY", "REASON", "SAME_AS")


def test_equal_lines_are_charged_once(spark):
    lines = [x for n in (1, 2, 3) for x in po_line(n)]
    cancels = [(f"CL{n}", TS, D("2"), "SLA", "free text") for n in (1, 2, 3)]
    got = traced(spark, oms_line=lines, rel_status=[s for n in (1, 2, 3) for s in statuses(n)], cancel_line=cancels)
    assert got == [("PL1", "charged", None), ("PL2", "same candidate as another line", "PL1"), ("PL3", "same candidate as another line", "PL1")]


def test_every_cancelled_line_has_a_reason(spark):
    lines = [x for n, over in ((1, {}), (2, {"cat": "983"}), (3, {"node": 99}), (4, {"item": 8})) for x in po_line(n, **over)]
    cancels = [("CL1", TS, D("2"), "SLA", "free text"), ("CL4", TS, D("2"), "REMORSE", None)]
    got = traced(spark, oms_line=lines, rel_status=[s for n in (1, 2, 3, 4) for s in statuses(n)], cancel_line=cancels)
    assert got == [("PL1", "charged", None), ("PL2", "category", None), ("PL3", "no ship node or created row", None), ("PL4", "remorse or no cancel code", None)]


@pytest.mark.parametrize("over, want", [
    ({"audit": [("PO1", "Price change", "a"), ("PO1", "Second reason", "b")]}, ["charged", "charged"]),
    ({"audit": [("PO1", "Weather Delay", "a"), ("PO1", "Second reason", "b")]}, ["audit reason", "charged"]),
    ({"note": [("PO1", "PO Not Received", "x")]}, ["exempt PO"]),
    ({"cancel_line": []}, ["remorse or no cancel code"]),
    ({"oms_order": [("PO1", "PO-1", TS, "0005")]}, ["charged"]),            # no chained order: no PO, no cost, charge 0
])
def test_reasons(spark, over, want):
    assert [r[1] for r in traced(spark, **over)] == want


def test_the_job_publishes_the_lineage(spark):
    inputs = make_inputs(spark, **base_710())
    out = jobs.run_rule_710(spark, inputs, MONDAY, table="T710_TRACED", lineage=True)
    assert [(r.LINE_KEY, float(r.CHARGE)) for r in spark.table(jobs.LINEAGE_710).collect()] == [("PL1", out.first()["CHARGEBACK_AMOUNT"])]
    spark.sql(f"DROP TABLE {jobs.LINEAGE_710}")


def test_old_working_sets_expire(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file://")
    old, new = (os.path.join(base, "chargewise-work", f"test-{age}") for age in ("old", "new"))
    for path, days in ((old, 20), (new, 1)):
        os.makedirs(os.path.join(path, "table"))
        then = (dt.datetime.now() - dt.timedelta(days=days)).timestamp()
        for p in (os.path.join(path, "table"), path):
            os.utime(p, (then, then))
    gone = working_set.expire(spark, dt.timedelta(days=14))
    assert [os.path.basename(p) for p in gone] == ["test-old"] and not os.path.exists(old) and os.path.exists(new)
