"""Inputs and windows that would silently empty a feed are errors; tables may carry the warehouse's names."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chargewise import catalog_queries as CQ
from chargewise import jobs, schemas, session
from chargewise.functions import dates
from chargewise.operators import joins, working_set
from chargewise.plans import rule_702, rule_706, runlog
from chargewise.sources.inputs import catalog_inputs, parquet_inputs, reviewer_file, reviewer_flags
from tests.conftest import SF_ORACLE

DAY = dt.date(2024, 3, 4)


def test_a_missing_window_is_an_error(spark):
    for start, end in ((None, DAY), (DAY, None), (None, None)):
        with pytest.raises(ValueError):
            dates.within(F.col("d"), start, end)
        with pytest.raises(ValueError):
            dates.ts_within(F.col("d"), start, end)
        flags = spark.createDataFrame([], schemas.INPUTS["flags"])
        with pytest.raises(ValueError):
            rule_706.rule_706(flags, start, end, DAY)


@pytest.mark.parametrize("argv", [
    ["rule_706", "--flags", "x"], ["rule_706_input", "--inputs-root", "x"], ["rule_706", "--flags", "x", "--start", "2024-01-01"],
    ["rule_706", "--start", "2024-01-01", "--end", "2024-01-07"], ["rule_702"], ["rule_710"]])
def test_jobs_ask_for_what_they_need(spark, argv):
    spark.createDataFrame([("kept",)], "x string").write.mode("overwrite").saveAsTable(jobs.OUT_706)
    with pytest.raises(SystemExit):
        jobs.main(argv)
    assert [r.x for r in spark.table(jobs.OUT_706).collect()] == ["kept"]
    spark.sql(f"DROP TABLE {jobs.OUT_706}")


def test_wrong_column_names_are_an_error(spark, tmp_path):
    spark.createDataFrame([("t", "z")], "tracking string, zone string").write.parquet(f"{tmp_path}/ups")
    with pytest.raises(ValueError, match="SC_UPS_TRACKING_NO"):
        parquet_inputs(spark, str(tmp_path))["ups"]


def csv(tmp_path, name, *lines):
    path = os.path.join(tmp_path, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_reviewer_csv(spark, tmp_path):
    good = csv(tmp_path, "good.csv", "PO_NUMBER,TRACKING_NUMBER,VIOLATE_FLAG,TOTAL_CHARGE_AMT,PICKUP_DATE", "po1,t1,Y,12.50,2024-03-04", ",t2,,,")
    rows = reviewer_flags(spark, good, "csv").collect()
    assert [(r.TRACKING_NUMBER, r.PO_NUMBER, r.TOTAL_CHARGE_AMT, r.VIOLATE_FLAG, r.PICKUP_DATE) for r in rows] == [
        ("t1", "po1", Decimal("12.50"), "Y", DAY), ("t2", None, None, None, None)]
    bad = csv(tmp_path, "bad.csv", "TRACKING_NUMBER,PO_NUMBER,TOTAL_CHARGE_AMT,VIOLATE_FLAG,PICKUP_DATE", "t1,po1,twelve,Y,2024-03-04")
    with pytest.raises(Exception, match="MALFORMED|twelve"):
        reviewer_flags(spark, bad, "csv").collect()
    names = csv(tmp_path, "names.csv", "TRK,PO_NUMBER,TOTAL_CHARGE_AMT,VIOLATE_FLAG,PICKUP_DATE", "t1,po1,1,Y,2024-03-04")
    with pytest.raises(ValueError, match="TRACKING_NUMBER"):
        reviewer_flags(spark, names, "csv")


HEADER = "TRACKING_NUMBER,PO_NUMBER,TOTAL_CHARGE_AMT,VIOLATE_FLAG,PICKUP_DATE"


def test_bad_lines_are_set_aside_with_number_and_reason(spark, tmp_path):
    path = csv(tmp_path, "some.csv", HEADER, "t1,po1,10.00,Y,2024-03-04", "t2,po2,ten,Y,2024-02-30", "", "t3,po3,1,Y", '"t4","po, 4",2.5,N,2024-03-04',
               ",po5,1,Y,2024-03-04", "t6,po6,1.005,Y,2024-03-04", "t7,po7,1.50,Y,2024-03-04")
    sent = spark.createDataFrame([("t1", Decimal("10.00")), ("t4", Decimal("3.00"))], "TRACKING_NUMBER string, TOTAL_CHARGE_AMT decimal(18,2)")
    read = reviewer_file(spark, path)
    assert sorted((r.TRACKING_NUMBER, r.PO_NUMBER, r.TOTAL_CHARGE_AMT) for r in read.flags.collect()) == [
        ("t1", "po1", Decimal("10.00")), ("t4", "po, 4", Decimal("2.50")), ("t7", "po7", Decimal("1.50"))]
    assert sorted((r.LINE_NO, r.REASON) for r in read.rejects.collect()) == [
        (3, "TOTAL_CHARGE_AMT is no decimal(18,2): ten; PICKUP_DATE is no date: 2024-02-30"), (5, "not 5 columns"), (7, "no TRACKING_NUMBER"),
        (8, "TOTAL_CHARGE_AMT is no decimal(18,2): 1.005")]
    assert [r.RECORD for r in read.rejects.where("LINE_NO = 5").collect()] == ["t3,po3,1,Y"]
    checked = reviewer_file(spark, path, sent)
    assert [r.TRACKING_NUMBER for r in checked.flags.collect()] == ["t1"]
    assert {(6, "TOTAL_CHARGE_AMT was changed"), (9, "this TRACKING_NUMBER was not sent")} <= {(r.LINE_NO, r.REASON) for r in checked.rejects.collect()}


def test_lines_are_numbered_across_splits(spark, tmp_path):
    lines = [f"t{i},po,{'x' if i % 97 == 0 else i}.00,Y,2024-03-04" for i in range(5000)]
    path = csv(tmp_path, "long.csv", HEADER, *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert sorted(r.LINE_NO for r in reviewer_file(spark, path).rejects.collect()) == [i + 2 for i in range(0, 5000, 97)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_job_lists_rejects(spark, tmp_path):
    path = csv(tmp_path, "flags.csv", HEADER, "t1,po1,10.00,Y,2024-03-04", "t2,po2,?,Y,2024-03-04")
    jobs.main(["rule_706", "--flags", path, "--flags-format", "csv", "--start", "2024-03-04", "--end", "2024-03-04", "--as-of", "2024-03-06"])
    assert [r.PO_NUMBER for r in spark.table(jobs.OUT_706).collect()] == ["po1"]
    assert [(r.LINE_NO, r.REASON) for r in spark.table(jobs.REJECTS_706).collect()] == [(3, "TOTAL_CHARGE_AMT is no decimal(18,2): ?")]
    spark.sql(f"DROP TABLE {jobs.OUT_706}")
    spark.sql(f"DROP TABLE {jobs.REJECTS_706}")


def test_reviewer_csv_through_the_job(spark, tmp_path):
    path = csv(tmp_path, "flags.csv", "TRACKING_NUMBER,PO_NUMBER,TOTAL_CHARGE_AMT,VIOLATE_FLAG,PICKUP_DATE",
               "t1,po1,10.00,Y,2024-03-04", "t2,po2,10.00,N,2024-03-04")
    jobs.main(["rule_706", "--flags", path, "--flags-format", "csv", "--start", "2024-03-04", "--end", "2024-03-04",
               "--as-of", "2024-03-06"])
    assert [(r.PO_NUMBER, r.CHARGEBACK_AMOUNT) for r in spark.table(jobs.OUT_706).collect()] == [("po1", 6.5)]
    spark.sql(f"DROP TABLE {jobs.OUT_706}")


def test_source_named_tables_give_the_adapter_result(spark, tmp_path):
    inputs = CQ.inputs_for(spark, SF_ORACLE)
    tables = {}
    for name in ("fsc", "oms_line", "fdx", "ups"):
        source = schemas.SOURCE_COLUMNS[name]
        tables[name] = f"src_{name}"
        inputs[name].select(*[F.col(c).alias(source[c]) for c in inputs[name].columns]).write.mode("overwrite").saveAsTable(tables[name])
    as_of, log = dt.date(1998, 6, 15), f"{tmp_path}/log"
    out = jobs.run_rule_702(spark, catalog_inputs(spark, tables), as_of, table="T702_SOURCE", p=CQ.TP.rule_702, log_path=log)
    start, end = dates.previous_week(as_of)
    want = rule_702.rule_702(inputs, start, end, as_of, CQ.TP.rule_702)
    assert out.count() > 0 and out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    run = runlog.latest_runs(runlog.read_log(spark, log), job="rule_702").collect()
    read = inputs["fsc"].filter(dates.within(F.col("order_date"), start, end)).count()
    assert [(r.ROWS_IN, r.ROWS_OUT) for r in run] == [(read, out.count())] and run[0].STARTED_AT is not None


def test_every_source_column_has_a_short_name():
    assert {n: {f.name for f in s.fields} for n, s in schemas.INPUTS.items()} == {n: set(c) for n, c in schemas.SOURCE_COLUMNS.items()}


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Cluster:
    conf = Conf({"spark.master": "spark://host:7077"})

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    monkeypatch.setattr(session, "_fallback_dir", None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_a_job_removes_its_working_sets(spark):
    seen = []

    @working_set.scoped
    def job(spark):
        seen.append(working_set.materialize(spark.range(10)).inputFiles()[0])
        return spark.read.parquet(seen[0]).count()

    assert job(spark) >= 1
    assert not os.path.exists(seen[0].removeprefix("file://"))


def test_left_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "r int, w string")
    got = joins.left_join(left, right, "k", "r").collect()
    want = left.join(right, left.k == right.r, "left").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_newest_runs_of_each_job(spark):
    rows = [(job, None, None, DAY, dt.datetime(2024, 3, 4, h), 1, h, None, "PUBLISHED", None, None, None) for job in ("a", "b") for h in range(8)]
    log = spark.createDataFrame(rows, runlog.RUN_LOG_SCHEMA)
    assert [(r.JOB, r.ROWS_OUT) for r in runlog.latest_runs(log, 2).collect()] == [("a", 7), ("b", 7), ("a", 6), ("b", 6)]
    assert [r.ROWS_OUT for r in runlog.latest_runs(log, 3, "b").collect()] == [7, 6, 5]
