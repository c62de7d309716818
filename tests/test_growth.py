"""What the rules over larger tables shuffle and write: histories staged once and on demand, pruned before a shuffle, ranked narrow."""

import math
import os

from pyspark.sql import functions as F

from chargewise import catalog_queries as CQ
from chargewise.operators.working_set import materialize
from chargewise.plans import rule_702, rule_710
from chargewise.sources.tpch import staged_tpch_inputs, tpch_inputs
from tests.conftest import SF_ORACLE, SF_SMALL, rows
from tools.plans import plan_text


def test_a_relation_is_staged_when_it_is_asked_for(spark, tmp_path):
    CQ.inputs_for(spark, SF_SMALL)
    staged = staged_tpch_inputs(spark, SF_SMALL, root=str(tmp_path))
    assert staged["cancel_line"].count() > 0
    target, = os.listdir(tmp_path)
    assert sorted(os.listdir(tmp_path / target)) == ["_lines", "cancel_line"]


def test_relations_of_lines_do_not_shuffle_them_again(spark, tmp_path):
    staged = staged_tpch_inputs(spark, SF_SMALL, root=str(tmp_path))
    staged["fdx"].schema
    target, = os.listdir(tmp_path)
    derived = tpch_inputs(spark, SF_SMALL, lambda: spark.read.parquet(f"{tmp_path}/{target}/_lines"))
    for name in ("oms_line", "rel_status", "cancel_line", "po_line", "fsc", "fdx", "ups", "ltl", "ltl_yw"):
        assert "Exchange" not in plan_text(derived[name]), name


def test_lines_meet_every_order_and_part_of_their_key(spark, tmp_path):
    """Lines without an order or a part stay lines; a key that repeats gives a row per match, as an inner join does."""
    for name in ("lineitem", "orders", "part", "supplier", "nation"):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "orders":
            df = df.filter(F.col("o_orderkey") % 5 != 0).unionByName(df.filter(F.col("o_orderkey") % 5 == 1))
        if name == "part":
            df = df.filter(F.col("p_partkey") % 7 != 0)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = tpch_inputs(spark, str(tmp_path))
    li, orders, part = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("lineitem", "orders", "part"))
    met = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    assert got["oms_line"].count() == met.count() + met.filter("o_orderstatus <> 'O'").count()
    assert got["fsc"].count() == li.count()
    assert rows(got["po_line"].groupBy("article_no").count()) == rows(
        li.join(part, F.col("l_partkey") == F.col("p_partkey")).filter("l_partkey % 9 <> 0")
          .groupBy(F.col("l_partkey").cast("string").alias("article_no")).count())


def test_a_history_of_some_hundred_megabytes_is_pruned_before_its_shuffle(spark):
    CQ.inputs_for(spark, SF_SMALL)
    size = spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")
    assert spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size) <= 100 << 20


def test_the_window_is_ranked_in_the_columns_the_rule_reads(spark, monkeypatch):
    inputs = CQ.inputs_for(spark, SF_ORACLE)
    week = rule_710.prepare_week(inputs, CQ.START, CQ.END)
    wide, written = week.top_in_window(), []
    original = rule_710.materialize
    monkeypatch.setattr(rule_710, "materialize", lambda df: written.append(df.columns) or original(df))
    narrow = rule_710.rank_top_status(inputs, week.matched, narrow=True).filter(F.col("status_ts").between(
        F.lit(CQ.START).cast("timestamp_ntz"), F.lit(CQ.END).cast("timestamp_ntz")))
    assert rows(narrow, *rule_710.NARROW_COLUMNS) == rows(wide, *rule_710.NARROW_COLUMNS)
    week.lines()
    assert len(written) == 5 and all("status_key" not in c and "release_key" not in c for c in written)


def test_written_slices_and_staged_tables_are_compact(spark, tmp_path):
    """zstd: snappy leaves about twice as much of keys that repeat their neighbours' beginnings."""
    CQ.inputs_for(spark, SF_SMALL)
    staged = staged_tpch_inputs(spark, SF_SMALL, root=str(tmp_path))
    for df in (staged["cancel_line"], materialize(staged["cancel_line"])):
        assert all(f.endswith(".zstd.parquet") for f in df.inputFiles())


def test_bloom_filters_hold_the_keys_of_the_six_gigabyte_tables(spark):
    """Few bits a key, so that small slices ship little; and 28.6 million keys (a year's parcels) still prune."""
    CQ.inputs_for(spark, SF_SMALL)
    root = "spark.sql.optimizer.runtime.bloomFilter."
    items, bits = int(spark.conf.get(root + "expectedNumItems")), int(spark.conf.get(root + "numBits"))
    hashes = max(1, round(bits / items * math.log(2)))
    assert hashes <= 3 and (1 - math.exp(-hashes * 28.6e6 / bits)) ** hashes < 0.15


def test_the_windows_slices_hold_what_the_rule_reads(spark, monkeypatch):
    inputs, written = CQ.inputs_for(spark, SF_SMALL), []
    original = rule_710.materialize
    monkeypatch.setattr(rule_710, "materialize", lambda df: written.append(set(df.columns)) or original(df))
    rule_710.run_rule_710(inputs, CQ.START, CQ.END, CQ.TEST_AS_OF, CQ.TP.rule_710)
    assert len(written) > 5
    assert not any({"status_key", "release_key", "carrier_service", "line_scac"} & c for c in written)


def test_the_run_log_computes_each_feed_of_the_year_once(spark, monkeypatch):
    """The combine run takes the feeds that the runs of their rules wrote."""
    calls = []
    for module, name in ((rule_702, "rule_702"), (rule_710, "run_rule_710")):
        original = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _f=original, _n=name, **k: calls.append(_n) or _f(*a, **k))
    log = CQ._logged(CQ.inputs_for(spark, SF_SMALL), [(CQ.START, CQ.END)]).collect()
    assert sorted(calls) == ["rule_702", "run_rule_710"]
    out = {r["JOB"]: r for r in log}
    assert sorted(out) == ["combine", "rule_702", "rule_706", "rule_706_input", "rule_710"]
    assert out["combine"]["ROWS_IN"] >= out["rule_702"]["ROWS_OUT"] + out["rule_710"]["ROWS_OUT"]
