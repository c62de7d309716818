"""Invariants over the adapter tables (sf0.001): schemas, exclusions, reduction equivalence."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from chargewise import catalog_queries as CQ
from chargewise import params as P
from chargewise import schemas
from chargewise.plans import rule_710
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def inputs(spark):
    return CQ.inputs_for(spark, SF_SMALL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == sorted(df.columns)


def test_feed_schemas(inputs):
    assert schemas.columns_and_types(CQ.feed_702(inputs).schema) == schemas.columns_and_types(schemas.feed_schema(P.FEED_702_COLUMNS))
    assert schemas.columns_and_types(CQ.feed_706(inputs).schema) == schemas.columns_and_types(schemas.feed_schema(P.FEED_706_COLUMNS))
    assert schemas.columns_and_types(CQ.feed_710(inputs).schema) == schemas.columns_and_types(schemas.feed_schema(P.FEED_710_COLUMNS))


def test_staging_column_lists(inputs):
    from chargewise.plans import rule_702
    assert tuple(rule_702.expedited_audit(inputs, CQ.START, CQ.END, CQ.TP.rule_702).columns) == rule_702.AUDIT_COLUMNS
    exempt = rule_710.rule_710_exempt(inputs, CQ.START, CQ.END, CQ.TP.rule_710)
    assert tuple(exempt.columns) == rule_710.EXEMPT_COLUMNS
    cancels = rule_710.rule_710_cancels(inputs, CQ.START, CQ.END, CQ.TP.rule_710)
    assert tuple(cancels.columns) == rule_710.CANCEL_COLUMNS


def test_702_has_no_zero_or_null_amounts(inputs):
    f = CQ.feed_702(inputs)
    assert f.filter(F.col("CHARGEBACK_AMOUNT").isNull() | (F.col("CHARGEBACK_AMOUNT") == 0)).count() == 0


def test_710_feed_has_no_exempt_po(inputs):
    exempt = rule_710.rule_710_exempt(inputs, CQ.START, CQ.END, CQ.TP.rule_710)
    exempt_pos = exempt.filter("DSV_EXCEPTION = 'Y'").select(F.col("PO_ORDER_NO").alias("PO_NUMBER"))
    assert CQ.feed_710(inputs).join(exempt_pos, "PO_NUMBER").count() == 0


def test_combine_count_equals_distinct_union(inputs):
    feeds = [CQ.feed_702(inputs), CQ.feed_706(inputs), CQ.feed_710(inputs)]
    union = feeds[0].unionByName(feeds[1], allowMissingColumns=True).unionByName(feeds[2], allowMissingColumns=True)
    combined = CQ.combined(inputs)
    assert combined.count() == union.distinct().count()
    first = combined.filter(~F.col("PO_NUMBER").endswith("_dup"))
    assert first.filter(F.col("PO_NUMBER").isNotNull()).select("PO_NUMBER").distinct().count() == \
        first.filter(F.col("PO_NUMBER").isNotNull()).count()


def test_rerun_gives_identical_rows(inputs):
    assert rows(CQ.feed_710(inputs)) == rows(CQ.feed_710(inputs))


def test_window_reduction_keeps_top_rows(inputs):
    """Ranking only the window's lines gives the same in-window top rows as ranking the history."""
    full = rule_710.top_status(inputs)
    week = rule_710.prepare_week(inputs, CQ.START, CQ.END)
    in_window = full.filter((F.to_date("status_ts") >= F.lit(CQ.START)) & (F.to_date("status_ts") <= F.lit(CQ.END)))
    assert rows(in_window) == rows(week.top_in_window())


def test_staged_inputs_equal_derived_inputs(spark, inputs):
    from chargewise.sources.tpch import tpch_inputs
    derived = tpch_inputs(spark, SF_SMALL)
    for name in ("rel_status", "oms_line", "fsc", "flags"):
        assert inputs[name].exceptAll(derived[name]).count() == 0
        assert derived[name].exceptAll(inputs[name]).count() == 0


def test_empty_window_gives_empty_feeds(inputs):
    """A week without data: every written working set is empty and the feeds are too."""
    import datetime as dt
    from chargewise.plans import rule_702, rule_706
    start, end = dt.date(2031, 1, 5), dt.date(2031, 1, 11)
    assert rule_710.run_rule_710(inputs, start, end, end, CQ.TP.rule_710).count() == 0
    assert rule_702.rule_702(inputs, start, end, end, CQ.TP.rule_702).count() == 0
    assert rule_706.bol_input(inputs, start, end).count() == 0


def test_entry_is_repeatable(spark):
    first, second = E.entry(spark), E.entry(spark)
    assert first.schema == second.schema
    assert rows(first) == rows(second)
