"""Job wrappers: window from the run date, table writes, run log, combine over tables."""

import datetime as dt
import tempfile

from chargewise import jobs
from chargewise.plans import runlog
from tests.test_rules import DAY, base_710, make_inputs

MONDAY = DAY + dt.timedelta(days=(7 - DAY.weekday()) % 7)  # the Monday after the test week


def test_rule_710_job_writes_table_and_log(spark):
    log = tempfile.mkdtemp(prefix="chargewise-log-") + "/runs"
    inputs = make_inputs(spark, **base_710())
    out = jobs.run_rule_710(spark, inputs, MONDAY, table="T710_OUT", log_path=log)
    assert out.count() == 1 and spark.table("T710_OUT").count() == 1
    start, end = jobs.previous_week(MONDAY)
    assert start <= DAY + dt.timedelta(days=2) <= end
    logged = runlog.latest_runs(runlog.read_log(spark, log)).collect()
    assert [(r.JOB, r.ROWS_OUT) for r in logged] == [("rule_710", 1)]


def test_combine_job_skips_missing_tables(spark):
    inputs = make_inputs(spark, **base_710())
    jobs.run_rule_710(spark, inputs, MONDAY, table="DMC710_OUT")
    msg = jobs.run_combine(spark, "702, 710", table="T_COMBINED")
    assert "1 feed(s) in; rules 710" in msg and "no feed for 702" in msg
    assert spark.table("T_COMBINED").count() == 1


def test_706_two_steps_with_reviewer_file(spark):
    from decimal import Decimal as D

    from pyspark.sql import functions as F

    from chargewise.sources.inputs import reviewer_flags
    from tests.test_rules import DAY

    charges = [("A", D("10"), D("1"), D("1"), D("0")), ("B", D("4"), D("0"), D("0"), D("0"))]
    headers = [("A", "po-1 ", "S1", DAY), ("B", "po-2", "S2", DAY)]
    inputs = make_inputs(spark, ltl_yw=charges, ltl=headers)
    bol = jobs.run_rule_706_input(spark, inputs, DAY, DAY, table="T706_IN")
    assert {r.PO_NUMBER: r.TOTAL_CHARGE_AMT for r in bol.collect()} == {"PO-1": D("12.00"), "PO-2": D("4.00")}
    # reviewers return the table with a flag per PRO number
    returned = tempfile.mkdtemp(prefix="chargewise-flags-") + "/flags"
    (spark.table("T706_IN")
        .select("TRACKING_NUMBER", "PO_NUMBER", "TOTAL_CHARGE_AMT",
                F.when(F.col("TRACKING_NUMBER") == "A", "Y").otherwise("N").alias("VIOLATE_FLAG"), "PICKUP_DATE")
        .write.parquet(returned))
    feed = jobs.run_rule_706(spark, reviewer_flags(spark, returned), DAY, DAY, DAY)
    got = feed.collect()
    assert len(got) == 1 and got[0].PO_NUMBER == "PO-1" and got[0].CHARGEBACK_AMOUNT == 7.8
    # the combine job finds the 706 feed under its own table name
    msg = jobs.run_combine(spark, "706", table="T_COMBINED_706")
    assert "rules 706" in msg and "no feed" not in msg and spark.table("T_COMBINED_706").count() == 1


def test_rule_710_job_keeps_staging_tables(spark):
    inputs = make_inputs(spark, **base_710(note=[("PO1", "Other", "hello")]))
    out = jobs.run_rule_710(spark, inputs, MONDAY, table="T710_STAGED", staging=True)
    assert out.count() == 1
    assert spark.table(jobs.STAGE_710_CANCELS).count() == 1
    assert [r.DSV_EXCEPTION for r in spark.table(jobs.STAGE_710_EXEMPT).collect()] == ["N"]
