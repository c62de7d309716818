"""Publishing: a failed write leaves the old table, a rerun week changes only that week, stale feeds aren't combined."""

import datetime as dt
import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from chargewise import jobs, schemas
from chargewise.operators.audit import Audit
from chargewise.plans import runlog
from chargewise.plans.combine import combine_tables
from chargewise.plans.runlog import StaleFeeds
from chargewise.sources import sinks
from tests.conftest import rows
from tests.test_rules import DAY, base_710, make_inputs

MONDAY = DAY + dt.timedelta(days=(7 - DAY.weekday()) % 7)


def frame(spark, *values):
    return spark.createDataFrame([(v, float(len(v))) for v in values], "PO_NUMBER string, CHARGEBACK_AMOUNT double")


def failing(spark):
    """Fails in the middle of the write, after some rows."""
    bad = F.when(F.col("PO_NUMBER") == "b", F.raise_error(F.lit("broken feed"))).otherwise(F.col("CHARGEBACK_AMOUNT"))
    return frame(spark, "a", "b", "c").repartition(3).withColumn("CHARGEBACK_AMOUNT", bad.cast("double"))


def leftovers(spark, table):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(table.lower()) and t.name != table.lower()]


def test_a_failing_write_keeps_the_old_table(spark):
    sinks.publish(frame(spark, "old"), "T_SAFE")
    with pytest.raises(Exception, match="broken feed"):
        sinks.publish(failing(spark), "T_SAFE")
    assert rows(spark.table("T_SAFE")) == [("old", 3.0)] and leftovers(spark, "t_safe") == []
    sinks.publish(frame(spark, "new", "rows"), "T_SAFE")
    assert rows(spark.table("T_SAFE"), "PO_NUMBER") == [("new",), ("rows",)] and leftovers(spark, "t_safe") == []


def test_a_failed_check_keeps_the_old_table(spark):
    sinks.publish(frame(spark, "old"), "T_CHECKED")
    gap = frame(spark, "x").withColumn("CHARGEBACK_AMOUNT", F.lit(None).cast("double"))
    for feed, options, why in ((gap, {"checks": [sinks.no_nulls("CHARGEBACK_AMOUNT")]}, "1 rows without CHARGEBACK_AMOUNT"),
                               (frame(spark), {"checks": [sinks.not_empty]}, "no rows"),
                               (frame(spark, "x"), {"schema": schemas.feed_schema(("PO_NUMBER",))}, "has the columns")):
        with pytest.raises(sinks.PublishError, match=why):
            sinks.publish(feed, "T_CHECKED", **options)
        assert rows(spark.table("T_CHECKED")) == [("old", 3.0)] and leftovers(spark, "t_checked") == []


def test_a_run_that_died_between_the_renames_is_put_right(spark):
    sinks.publish(frame(spark, "old"), "T_DIED")
    spark.sql("ALTER TABLE T_DIED RENAME TO T_DIED__outgoing")
    with pytest.raises(Exception, match="broken feed"):
        sinks.publish(failing(spark), "T_DIED")
    assert rows(spark.table("T_DIED")) == [("old", 3.0)]
    frame(spark, "older").write.saveAsTable("T_DIED__outgoing")        # died after the second rename
    sinks.recover(spark, "T_DIED")
    assert rows(spark.table("T_DIED")) == [("old", 3.0)] and leftovers(spark, "t_died") == []


def test_a_rerun_week_changes_only_that_week(spark):
    weeks = [(dt.date(2025, 7, 27), dt.date(2025, 8, 2)), (dt.date(2025, 8, 3), dt.date(2025, 8, 9))]

    def put(week, *values):
        sinks.keep_window(sinks.publish(frame(spark, *values), "T_WEEKS"), "T_WEEKS", *week)
        return rows(spark.table("T_WEEKS_HISTORY"), "PO_NUMBER", "WINDOW_START")

    put(weeks[0], "a", "b")
    assert put(weeks[1], "c") == [("a", weeks[0][0]), ("b", weeks[0][0]), ("c", weeks[1][0])]
    assert put(weeks[0], "d") == [("c", weeks[1][0]), ("d", weeks[0][0])]
    assert put(weeks[0]) == [("c", weeks[1][0])]
    assert rows(spark.table("T_WEEKS")) == []


# --- the run log and what it tells the combine job

def new_log():
    return tempfile.mkdtemp(prefix="chargewise-log-") + "/runs"


def test_failed_runs_are_logged_and_their_feeds_not_combined(spark):
    log, tables = new_log(), {"710": "T_FRESH_710", "702": "T_FRESH_702"}
    inputs = make_inputs(spark, **base_710(note=[("PO1", "Other", "hello")]))
    jobs.run_rule_710(spark, inputs, MONDAY, table="T_FRESH_710", log_path=log)
    message = jobs.run_combine(spark, "702,710", table="T_FRESH", log_path=log, as_of=MONDAY, tables=tables)
    assert "no feed for 702" in message                     # never published: skipped
    combined = rows(spark.table("T_FRESH"))

    broken = inputs.with_frame("note", inputs["note"].withColumn("txt", F.raise_error(F.lit("broken notes")).cast("string")))
    with pytest.raises(Exception, match="broken notes"):
        jobs.run_rule_710(spark, broken, MONDAY, table="T_FRESH_710", log_path=log)
    assert spark.table("T_FRESH_710").count() == 1          # last good feed
    with pytest.raises(StaleFeeds, match="rule 710: its last run .* failed: .*broken notes"):
        jobs.run_combine(spark, "702,710", table="T_FRESH", log_path=log, as_of=MONDAY, tables=tables)
    assert rows(spark.table("T_FRESH")) == combined
    logged = runlog.read_log(spark, log)
    assert rows(logged, "JOB", "STATUS") == [("combine", "FAILED"), ("combine", "PUBLISHED"), ("rule_710", "FAILED"), ("rule_710", "PUBLISHED")]

    jobs.run_rule_710(spark, inputs, MONDAY, table="T_FRESH_710", log_path=log)
    assert "rules 710" in jobs.run_combine(spark, "702,710", table="T_FRESH", log_path=log, as_of=MONDAY, tables=tables)


def test_old_half_written_and_unlogged_feeds_are_stale(spark):
    log, tables = new_log(), {"710": "T_STALE_710", "702": "T_STALE_702"}
    jobs.run_rule_710(spark, make_inputs(spark, **base_710()), MONDAY, table="T_STALE_710", log_path=log)

    def stale(rules, as_of=MONDAY):
        with pytest.raises(StaleFeeds) as e:
            jobs.run_combine(spark, rules, table="T_STALE", log_path=log, as_of=as_of, tables=tables)
        return e.value.reasons

    assert "not of" in stale("710", MONDAY + dt.timedelta(days=7))["710"]       # a week old
    frame(spark, "x").write.saveAsTable("T_STALE_702")
    spark.sql("TRUNCATE TABLE T_STALE_710")
    assert stale("702,710") == {"702": "no logged run wrote T_STALE_702", "710": "T_STALE_710 holds 0 rows, its run wrote 1"}
    spark.sql("DROP TABLE T_STALE_710")
    assert stale("710") == {"710": "T_STALE_710 is gone"}
    assert combine_tables(spark, "702", tables=tables).merged == ["702"]        # without a log: by existence


def test_the_log_says_what_was_dropped(spark):
    log = new_log()
    inputs = make_inputs(spark, **base_710())
    jobs.run_rule_710(spark, inputs, MONDAY, table="T_DROPS", log_path=log)
    row = runlog.read_log(spark, log).first()
    assert row["STATUS"] == "PUBLISHED" and row["OUTPUT_TABLE"] == "T_DROPS" and row["ROWS_OUT"] == 1 and row["ERROR"] is None
    assert row["ROWS_IN"] > 0 and set(row["DROPPED"]) == {"category", "remorse or no cancel code", "exempt PO", "audit reason", "cancel note"}
    assert row["AMOUNT_TOTAL"] == D(str(spark.table("T_DROPS").first()["CHARGEBACK_AMOUNT"])).quantize(D("0.000001"))


def test_audit_counts_each_row_once(spark):
    audit = Audit()
    df = audit.read(spark.range(1000).repartition(7))
    df = audit.exclude(df, F.when(F.col("id") % 10 < 8, F.col("id") % 2 == 0), "odd or unknown")
    df = audit.without(df, lambda x: x.join(spark.range(0, 1000, 4).withColumnRenamed("id", "k"), F.col("id") == F.col("k"), "left_anti"), "fours")
    out = audit.written(df.withColumn("x", F.lit(0.25)), "x")
    out.write.format("noop").mode("overwrite").save()
    left = [i for i in range(1000) if i % 10 < 8 and i % 2 == 0]
    kept = [i for i in left if i % 4]
    assert audit.rows_read() == 1000 and audit.dropped() == {"odd or unknown": 1000 - len(left), "fours": len(left) - len(kept)}
    assert audit.rows_written() == (len(kept), D("0.25") * len(kept))


def test_audit_of_a_frame_cut_from_the_plan(spark, monkeypatch):
    monkeypatch.setattr("chargewise.operators.audit.WAIT_S", 1)
    audit = Audit()
    never = audit.read(spark.range(5))
    spark.range(3).write.format("noop").mode("overwrite").save()
    assert never.columns == ["id"] and audit.rows_read() == 5
