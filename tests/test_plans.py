"""Plan shape of the weekly jobs.

With a one-week window, history tables are filtered by broadcast semi joins
against the week's written slices and never shuffled whole. Where the slices
are too large to broadcast, every history scan is pruned by a bloom filter of
the slice's keys before its shuffle.
"""

import datetime as dt
import threading

import pytest

from chargewise import catalog_queries as CQ
from chargewise.plans import rule_702, rule_706, rule_710
from tests.conftest import SF_ORACLE
from tools.plans import METADATA_LENGTH, plan_text, scans

HISTORY = ("rel_status", "oms_line", "oms_order", "note", "audit", "cancel_line", "po_line", "fdx", "ups")
WEEK = (dt.date(1998, 6, 7), dt.date(1998, 6, 13))
LIMITS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
BLOOM_FROM = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


@pytest.fixture
def conf(spark):
    old = {k: spark.conf.get(k) for k in (*LIMITS, METADATA_LENGTH, BLOOM_FROM)}
    spark.conf.set(METADATA_LENGTH, "1000")
    yield spark.conf
    for k, v in old.items():
        spark.conf.set(k, v)


def week_plans(spark, monkeypatch, stops, settings) -> list[list[tuple]]:
    """The history scans of every written slice and of both feeds, for one week."""
    inputs = CQ.inputs_for(spark, SF_ORACLE)
    for k, v in settings.items():               # after the inputs, which tune the session
        spark.conf.set(k, v)
    seen = []
    original = rule_710.materialize
    lock = threading.Lock()  # two slices are written from two threads; stdout capture is global

    def note(df):
        with lock:
            seen.append([s for s in scans(plan_text(df), stops) if s[0] in HISTORY])

    def spy(df):
        note(df)
        return original(df)

    for module in (rule_710, rule_702, rule_706):
        monkeypatch.setattr(module, "materialize", spy)
    start, end = WEEK
    week = rule_710.prepare_week(inputs, start, end)
    note(rule_710.rule_710(rule_710.rule_710_cancels(inputs, start, end, CQ.TP.rule_710, week),
                           rule_710.rule_710_exempt(inputs, start, end, CQ.TP.rule_710, week),
                           CQ.TEST_AS_OF, CQ.TP.rule_710))
    note(rule_702.rule_702(inputs, start, end, None, CQ.TP.rule_702))
    return seen


def test_history_tables_are_not_shuffled(spark, conf, monkeypatch):
    # Every staged history counts as large (as in production) while the one-week slices stay small.
    seen = week_plans(spark, monkeypatch, ("Exchange", "BroadcastExchange", "BroadcastHashJoin"), dict.fromkeys(LIMITS, "200KB"))
    # step 1 aggregates the week's own status rows into distinct line keys: that shuffle is expected
    assert [(t, above) for t, above, _ in seen[0]] == [("rel_status", "Exchange")]
    met = [(t, above) for step in seen[1:] for t, above, _ in step]
    assert not [x for x in met if x[1] == "Exchange"]
    assert len(set(met)) >= 8


def test_bloom_filters_prune_the_histories_beyond_the_broadcast_limit(spark, conf, monkeypatch):
    seen = week_plans(spark, monkeypatch, ("Exchange",), dict.fromkeys(LIMITS, "-1") | {BLOOM_FROM: "0"})
    shuffled = [(t, between) for step in seen[1:] for t, above, between in step if above == "Exchange"]
    assert {t for t, _ in shuffled} == set(HISTORY)
    unpruned = [t for t, between in shuffled if not any("might_contain" in line for line in between)]
    assert not unpruned, [b for t, b in shuffled if t in unpruned]


def test_top_status_reads_the_history_once(spark, conf, monkeypatch):
    inputs = CQ.inputs_for(spark, SF_ORACLE)
    seen = []
    original = rule_710.materialize

    def spy(df):
        seen.append(plan_text(df))
        return original(df)

    monkeypatch.setattr(rule_710, "materialize", spy)
    seen.append(plan_text(rule_710.top_status_report(inputs)))
    assert sum(t == "rel_status" for plan in seen for t, _, _ in scans(plan)) == 1
