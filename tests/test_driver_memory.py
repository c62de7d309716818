"""What a plan puts on the driver: broadcast relations and the key filters that tasks carry."""

import pytest
from pyspark.sql import functions as F

from chargewise import catalog_queries as CQ
from chargewise.operators import joins
from chargewise.operators.working_set import materialize
from chargewise.plans import combine, rule_702, rule_710
from chargewise.session import tune
from tests.conftest import SF_SMALL
from tests.test_plans import HISTORY
from tools.plans import METADATA_LENGTH, plan_text, scans


@pytest.fixture
def spied(spark, monkeypatch):
    """The histories scanned by each plan that a module writes."""
    old = spark.conf.get(METADATA_LENGTH)
    spark.conf.set(METADATA_LENGTH, "1000")
    seen = []

    def spy(df):
        seen.append({s[0] for s in scans(plan_text(df))} & {*HISTORY, "fsc"})
        return materialize(df)

    def watch(module):
        monkeypatch.setattr(module, "materialize", spy)
        return seen

    yield watch
    spark.conf.set(METADATA_LENGTH, old)


def test_a_million_keys_are_not_broadcast_however_small_their_file(spark):
    tune(spark)
    keys = materialize(spark.range(1_200_000).select(F.col("id").cast("string").alias("k")).coalesce(1))
    history = materialize(spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")))
    plan = plan_text(joins.exists_in(keys.withColumn("v", F.lit(1)), keys, "k"))
    assert "BroadcastHashJoin" not in plan
    assert "BroadcastHashJoin" in plan_text(joins.exists_in(keys, history, "k"))


def test_rule_702_meets_one_history_in_a_plan(spark, spied):
    seen = spied(rule_702)
    rule_702.expedited_audit(CQ.inputs_for(spark, SF_SMALL), CQ.START, CQ.END, CQ.TP.rule_702)
    assert {"oms_line"} in seen and {"fdx"} in seen and {"ups"} in seen


def test_rule_710_meets_cancel_and_po_history_in_plans_of_their_own(spark, spied):
    seen = spied(rule_710)
    rule_710.rule_710_cancels(CQ.inputs_for(spark, SF_SMALL), CQ.START, CQ.END, CQ.TP.rule_710)
    assert {"cancel_line"} in seen and {"po_line"} in seen


def test_combine_unites_written_feeds(spark, spied):
    seen = spied(combine)
    CQ.combined(CQ.inputs_for(spark, SF_SMALL))
    assert seen == [set()]


def test_combine_without_ids_unites_written_feeds(spark, spied):
    seen = spied(combine)
    CQ._without_ids(CQ.inputs_for(spark, SF_SMALL))
    assert seen == [set()]
