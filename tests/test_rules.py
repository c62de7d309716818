"""Rule tests on hand-made input relations (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal as D

from chargewise import params as P
from chargewise import schemas
from chargewise.plans import rule_702, rule_706, rule_710
from chargewise.sources.inputs import Inputs
from tests.conftest import rows

DAY = dt.date(2025, 3, 5)
TS = dt.datetime(2025, 3, 5, 10, 0)


def make_inputs(spark, **tables):
    frames = {name: spark.createDataFrame(data, schemas.INPUTS[name]) for name, data in tables.items()}
    for name, schema in schemas.INPUTS.items():
        frames.setdefault(name, spark.createDataFrame([], schema))
    return Inputs({name: (lambda f=f: f) for name, f in frames.items()})


def line(key, order_key, chain_order=None, chain_line=None, item=1, node=1, price="10", qty="2", cat="5",
         service="Ground"):
    return (key, order_key, chain_order, chain_line, item, node, D(price), D(qty), cat, TS, service, "SC")


# --- rule 702 -------------------------------------------------------------------------------

def run_702(spark, freight, fdx=(), ups=()):
    lines = [line(f"L{i}", "O") for i in range(1, 10)]
    inp = make_inputs(spark, fsc=freight, oms_line=lines, fdx=list(fdx), ups=list(ups))
    return rule_702.rule_702(inp, DAY, DAY, DAY, P.Rule702Params(excluded_ship_nodes=("7",)))


def test_702_amounts_zero_null_and_sign(spark):
    freight = [("P1", "S1", DAY, "L1", "X", "T1", D("-20")),
               ("P2", "S2", DAY, "L2", "X", "T2", None),
               ("P3", "S3", DAY, "L3", "X", "T3", D("-50"))]
    fdx = [("T1", "FedEx 2Day"), ("T2", "FedEx 2Day"), ("T3", "FedEx 2Day")]
    out = run_702(spark, freight, fdx)
    assert rows(out, "PO_NUMBER", "CHARGEBACK_AMOUNT") == [("P3", 30.0)]
    assert schemas.columns_and_types(out.schema) == schemas.columns_and_types(schemas.feed_schema(P.FEED_702_COLUMNS))


def test_702_duplicates_after_narrowing(spark):
    freight = [("P1", "S1", DAY, "L1", "X", "T1", D("5")), ("P1", "S2", DAY, "L1", "X", "T1", D("5"))]
    out = run_702(spark, freight, [("T1", "FedEx 2Day")])
    assert out.count() == 2 and out.distinct().count() == 1


def test_702_null_tracking_and_window(spark):
    freight = [("P1", "S1", DAY, "L1", "X", None, D("5")),
               ("P2", "S2", DAY + dt.timedelta(days=1), "L2", "X", "T2", D("5")),
               (None, "S3", DAY, "L3", "X", "T3", D("5"))]
    out = run_702(spark, freight, ups=[(None, "9")])
    # NULL tracking never joins an invoice, so both invoice sides are NULL: dropped.
    assert out.count() == 0
    out = run_702(spark, freight[:1], fdx=[])
    assert out.count() == 0


# --- rule 706 -------------------------------------------------------------------------------

def test_706_input_null_parts_and_fan_out(spark):
    charges = [("A", D("10"), None, D("1"), D("0")), ("A", D("5"), D("1"), D("1"), D("0")),
               ("B", D("10"), D("0"), D("0"), D("1"))]
    headers = [("A", " b1", "S1", DAY), ("A", "A9 ", "S2", DAY), ("B", "p", "S", DAY),
               ("C", "q", "S", DAY)]
    inp = make_inputs(spark, ltl_yw=charges, ltl=headers)
    out = {r.TRACKING_NUMBER: r for r in rule_706.bol_input(inp, DAY, DAY).collect()}
    assert set(out) == {"A", "B"}
    a, b = out["A"], out["B"]
    # each charge counts once per header row of its PRO (two headers for A)
    assert a.GROSS_CHARGE_AMT == D("30.00") and a.FUEL_SURCHARGE_AMT == D("2.00")
    assert a.TOTAL_CHARGE_AMT == D("14.00")       # (5 + 1 + 1) x 2; the NULL-fuel row is left out
    assert a.PO_NUMBER == "A9" and a.SHIPPER_NAME == "S2"
    assert b.GROSS_CHARGE_AMT == D("10.00") and b.DISC_AMT == D("1.00")


def test_706_charges_flagged_rows_in_window(spark):
    flags = [("T1", "P1", D("100"), "Y", DAY), ("T2", "P2", D("-10"), "Y", DAY), ("T3", "P3", D("5"), "N", DAY),
             ("T4", "P4", D("5"), "Y", DAY + dt.timedelta(days=2)), (None, "P5", D("1"), "Y", DAY)]
    inp = make_inputs(spark, flags=flags)
    out = rule_706.rule_706(inp["flags"], DAY, DAY, DAY)
    got = {r.PO_NUMBER: (r.CHARGEBACK_AMOUNT, r.AUDIT_COMMENTS) for r in out.collect()}
    assert set(got) == {"P1", "P2", "P5"}
    assert got["P1"][0] == 65.0 and got["P2"][0] == 6.5 and got["P5"][1] is None
    assert out.columns[-1] == "ANCHOR_CONST"


# --- rule 710 -------------------------------------------------------------------------------

def status(line_key, order_key, sched, st, ts, qty="2"):
    return (f"{line_key}-{sched}-{st}", f"{order_key}-{sched}", line_key, order_key, sched, st, ts,
            None if qty is None else D(qty))


def base_710(**over):
    t1, t2, t3 = TS, TS + dt.timedelta(days=1), TS + dt.timedelta(days=2)
    tables = dict(
        oms_order=[("PO1", "PO-1", TS, "0005"), ("C1", "SO-1", TS, "0001")],
        oms_line=[line("PL1", "PO1", "C1", "CL1", item=7), line("CL1", "C1", item=7)],
        rel_status=[status("PL1", "PO1", "1", "1100", t1), status("PL1", "PO1", "1", "3200", t2),
                    status("PL1", "PO1", "1", "9000", t3)],
        status_dim=[("1100", "Created", "PO_FULFILLMENT"), ("3200", "Released", "PO_FULFILLMENT"),
                    ("9000", "Cancelled", "PO_FULFILLMENT"), ("9000", "Cancelled", "ORDER_FULFILLMENT")],
        time_dim=[(TS.date(),)],
        ship_node=[(1, "Node 1")],
        cancel_line=[("CL1", t3, D("2"), "SLA", "free text")],
        po_line=[("PO-1", 7, D("100"), DAY, 3, 9)],
        store=[(3, 30)], article=[(7,)], vendor=[(9,)],
    )
    tables.update(over)
    return tables


WEEK = (DAY, DAY + dt.timedelta(days=6))


def feed_710(spark, p=P.Rule710Params(), **over):
    inp = make_inputs(spark, **base_710(**over))
    return rule_710.run_rule_710(inp, *WEEK, DAY, p)


def test_710_charges_three_percent(spark):
    out = feed_710(spark)
    r = out.collect()
    assert len(r) == 1 and r[0].PO_NUMBER == "PO-1" and r[0].CHARGEBACK_AMOUNT == 6.0
    assert r[0].AUDIT_COMMENTS == "Order Date: 2025-03-05;Cancellation Date: 2025-03-07;"
    assert schemas.columns_and_types(out.schema) == schemas.columns_and_types(schemas.feed_schema(P.FEED_710_COLUMNS))


def test_710_top_status_only_rows_at_latest_timestamp(spark):
    # 9000 at t1 is older than the schedule's latest row (3200 at t2): top is 3200, nothing charged.
    t1, t2 = TS, TS + dt.timedelta(days=1)
    out = feed_710(spark, rel_status=[status("PL1", "PO1", "1", "1100", t1), status("PL1", "PO1", "1", "9000", t1),
                                      status("PL1", "PO1", "1", "3200", t2)])
    assert out.count() == 0


def test_710_two_schedules_tie(spark):
    t1, t3 = TS, TS + dt.timedelta(days=2)
    inp = make_inputs(spark, **base_710(rel_status=[
        status("PL1", "PO1", "1", "1100", t1), status("PL1", "PO1", "1", "9000", t3),
        status("PL1", "PO1", "2", "9000", t3)]))
    top = rule_710.top_status(inp)
    # each 9000 row matches both schedules' latest timestamp
    assert top.count() == 4 and {r.sched for r in top.collect()} == {"1", "2"}
    assert rule_710.run_rule_710(inp, *WEEK, DAY).collect()[0].CHARGEBACK_AMOUNT == 6.0


def test_710_exempt_po_is_removed(spark):
    out = feed_710(spark, note=[("PO1", "PO Not Received", None)])
    assert out.count() == 0
    out = feed_710(spark, note=[("PO1", "Other", "Closed for Federal Holiday today")])
    assert out.count() == 0
    out = feed_710(spark, note=[("PO1", "Other", "hello")])
    assert out.count() == 1


def test_710_remorse_and_missing_cancel_are_dropped(spark):
    t3 = TS + dt.timedelta(days=2)
    assert feed_710(spark, cancel_line=[("CL1", t3, D("2"), "REMORSE", None)]).count() == 0
    assert feed_710(spark, cancel_line=[]).count() == 0
    assert feed_710(spark, cancel_line=[("CL1", t3, D("2"), "SLA", None)]).count() == 1


def test_710_excluded_reasons(spark):
    t3 = TS + dt.timedelta(days=2)
    assert feed_710(spark, audit=[("PO1", "Weather Delay", "t")]).count() == 0
    assert feed_710(spark, cancel_line=[("CL1", t3, D("2"), "SLA", "Closed for Federal Holiday")]).count() == 0


def test_710_two_audit_codes_double_the_cost(spark):
    out = feed_710(spark, audit=[("PO1", "Price change", "a"), ("PO1", "Second reason", "b")])
    assert out.collect()[0].CHARGEBACK_AMOUNT == 12.0


def test_710_no_cost_and_no_chained_order(spark):
    out = feed_710(spark, po_line=[])
    assert out.collect()[0].CHARGEBACK_AMOUNT == 0.0
    inp = make_inputs(spark, **base_710(oms_line=[line("PL1", "PO1", None, "CL1", item=7), line("CL1", "C1")]))
    r = rule_710.run_rule_710(inp, *WEEK, DAY).collect()
    assert len(r) == 1 and r[0].PO_NUMBER is None and r[0].CHARGEBACK_AMOUNT == 0.0


def test_710_excluded_category_and_missing_chained_line(spark):
    assert feed_710(spark, oms_line=[line("PL1", "PO1", "C1", "CL1", item=7, cat="983"),
                                     line("CL1", "C1")]).count() == 0
    assert feed_710(spark, oms_line=[line("PL1", "PO1", "C1", "CLX", item=7)]).count() == 0
    assert feed_710(spark, oms_line=[line("PL1", "PO1", "C1", "CL1", item=7, cat=None),
                                     line("CL1", "C1")]).count() == 0


def test_710_window_applies_to_top_status_time(spark):
    inp = make_inputs(spark, **base_710())
    late = (DAY + dt.timedelta(days=7), DAY + dt.timedelta(days=13))
    assert rule_710.run_rule_710(inp, *late, DAY).count() == 0
