"""Histories stored by date: a window opens its own partitions only, and the results stay the same."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from chargewise import catalog_queries as CQ
from chargewise import schemas
from chargewise.functions import dates
from chargewise.plans import rule_702, rule_706, rule_710, top_state
from chargewise.sources import layout
from chargewise.sources.inputs import named
from tests.conftest import SF_ORACLE, rows
from tools.plans import METADATA_LENGTH, plan_text

WEEK = (dt.date(1998, 6, 28), dt.date(1998, 7, 4))         # lies in two months
READS = {"rel_status": rule_710.lines_active_in, "fsc": rule_702.expedited_audit, "ltl": rule_706.bol_input}


def headers(spark, data):
    return spark.createDataFrame([(p, "po", "s", d) for p, d in data], schemas.INPUTS["ltl"])


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    inputs = CQ.inputs_for(spark, SF_ORACLE)
    root = tmp_path_factory.mktemp("by-date")
    paths = {name: f"{root}/{name}" for name in READS}
    for name, path in paths.items():
        layout.write_by_date(inputs[name], name, path, "month")
    return inputs, layout.with_dates(inputs, paths, spark)


@pytest.mark.parametrize("relation", READS)
def test_a_week_opens_its_partitions_only(spark, stored, relation, monkeypatch):
    plain, by_date = stored
    column = schemas.WINDOW_DATE[relation]
    week = dates.rows_in(by_date[relation], column, *WEEK)
    assert rows(week.drop(f"{column}_month")) == rows(dates.rows_in(plain[relation], column, *WEEK))

    spark.conf.set(METADATA_LENGTH, "1000")
    plan = plan_text(week)
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert f"{column}_month" in filters and "1998-06-01" in filters and "1998-07-04" in filters
    pushed = plan.split("PushedFilters: [")[1]
    assert f"GreaterThanOrEqual({column}," in pushed          # the raw column still bounds row groups
    # Every file that the scan opens lies in one of the week's two months.
    whole = set(by_date[relation].inputFiles())
    opened = {r[0] for r in by_date[relation].filter(dates.within(F.col(f"{column}_month"), WEEK[0].replace(day=1), WEEK[1]))
              .select(F.input_file_name()).distinct().collect()}
    assert {f.split(f"{column}_month=")[1][:7] for f in opened} == {"1998-06", "1998-07"} and len(opened) < len(whole) / 10


def test_rules_prune_and_agree(spark, stored):
    plain, by_date = stored
    for job in (lambda i: rule_702.rule_702(i, *WEEK, CQ.TEST_AS_OF, CQ.TP.rule_702), lambda i: rule_706.bol_input(i, *WEEK),
                lambda i: rule_710.run_rule_710(i, *WEEK, CQ.TEST_AS_OF, CQ.TP.rule_710)):
        assert rows(job(by_date)) == rows(job(plain)) != []


def test_a_week_is_merged_into_the_state(spark, stored):
    plain, by_date = (i["rel_status"] for i in stored)
    day = WEEK[0] - dt.timedelta(days=1)
    state = top_state.competing(top_state.until(plain, day))
    merged = top_state.merged(state, dates.rows_in(by_date, "status_ts", *WEEK), top_state.until(by_date, WEEK[1]))
    assert rows(merged) == rows(top_state.competing(top_state.until(plain, WEEK[1])))


def test_a_date_is_replaced_and_null_dates_stay(spark, tmp_path):
    path = str(tmp_path / "ltl")
    day = dt.date(2025, 1, 31)
    first = [("a", day), ("b", day), ("c", day + dt.timedelta(days=1)), ("n", None)]
    layout.write_by_date(headers(spark, first), "ltl", path)
    layout.write_by_date(headers(spark, [("x", day)]), "ltl", path)
    read = named(spark.read.parquet(path), "ltl")
    assert sorted(r.pro_no for r in read.collect()) == ["c", "n", "x"]
    assert [r.pro_no for r in dates.rows_in(read, "pickup_date", day, day).collect()] == ["x"]
    assert [r.pro_no for r in dates.rows_in(read, "pickup_date", day, dt.date(2025, 2, 28)).orderBy("pro_no").collect()] == ["c", "x"]
    with pytest.raises(ValueError):
        layout.write_by_date(read, "ltl", path, "year")


def test_a_date_with_a_third_of_the_rows_is_written_by_many_tasks(spark, tmp_path):
    rng, day, path = random.Random(4), dt.datetime(2025, 1, 5), str(tmp_path / "status")
    data = [(f"k{i}", "r", f"L{rng.randrange(9000)}", "O", "s", "1100", day + dt.timedelta(days=0 if i % 3 == 0 else rng.randrange(60)), D("1.00"))
            for i in range(9000)]
    frame = spark.createDataFrame(data, schemas.INPUTS["rel_status"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_by_date(frame, "rel_status", path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in spark.read.parquet(path).inputFiles() if "status_ts_day=2025-01-05" in f]
    assert len(files) > 1
    assert rows(named(spark.read.parquet(path), "rel_status").drop("status_ts_day")) == rows(frame)
