"""The registered queries: every job and operator family over the test tables.

Each entry is `(spark, sf_dir) -> DataFrame` and reads the given tables
(directly or through the adapters in `chargewise.sources.tpch`), so the
work grows with the scale factor.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargewise.functions import dates
from chargewise.operators.working_set import materialize, remove
from chargewise.params import TestDataParams
from chargewise.plans import combine, families, rule_702, rule_706, rule_710, runlog, top_state
from chargewise.session import ensure_checkpoint_dir, tune
from chargewise.sources import layout, sinks
from chargewise.sources.inputs import reviewer_file
from chargewise.sources.tpch import TEST_AS_OF, TEST_WINDOW, full_list_inputs, staged_tpch_inputs

TP = TestDataParams()
START, END = TEST_WINDOW
START_STATE = dt.date(1998, 6, 6)      # the top-status state of the weekly query begins with the rows up to here


def inputs_for(spark: SparkSession, sf_dir: str):
    tune(spark)
    return staged_tpch_inputs(spark, sf_dir)


def feed_702(inputs) -> DataFrame:
    return rule_702.rule_702(inputs, START, END, TEST_AS_OF, TP.rule_702)


def feed_706(inputs) -> DataFrame:
    return rule_706.rule_706(inputs["flags"], START, END, TEST_AS_OF)


def feed_710(inputs) -> DataFrame:
    return rule_710.run_rule_710(inputs, START, END, TEST_AS_OF, TP.rule_710)


def combined(inputs) -> DataFrame:
    # Each feed is written before the next is planned: in one plan the broadcasts and key filters of all rules would be on the
    # driver at once.
    feeds = {rule: materialize(feed(inputs)) for rule, feed in (("702", feed_702), ("706", feed_706), ("710", feed_710))}
    return combine.combine_frames(feeds, "702,706,710").frame


def _q(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(inputs_for(spark, sf_dir))


def _months() -> list[tuple[dt.date, dt.date]]:
    firsts = [dt.date(START.year, m, 1) for m in range(START.month, END.month + 1)]
    return [(d, (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)) for d in firsts]


def _run(job, first, last, run_date, hour, amount="CHARGEBACK_AMOUNT"):
    return runlog.Run(job, first, last, run_date, amount=amount, started_at=dt.datetime.combine(run_date, dt.time(hour)))


def _cut_706(inputs, windows):
    """For each window the inputs with all that it reads of the freight histories: headers of the span of days, and the charges of its
    own PRO numbers. Both are written, the charges once for each window that has a header of their PRO number."""
    headers = materialize(dates.rows_in(inputs["ltl"], "pickup_date", min(w[0] for w in windows), max(w[1] for w in windows)))
    within = [F.when(dates.within(F.col("pickup_date"), *w), F.lit(i)) for i, w in enumerate(windows)]
    numbers = materialize(headers.select(F.col("pro_no").alias("_pro"), F.explode(F.array_compact(F.array(*within))).alias("_window")).distinct())
    # True of every number: with a predicate on them the planner prunes the history by a filter of the numbers.
    met = inputs["ltl_yw"].join(numbers.filter(F.col("_pro") >= F.lit("")), F.col("pro_no") == F.col("_pro")).drop("_pro")
    charges = materialize(met.sortWithinPartitions("_window"))
    cut = inputs.with_frame("ltl", headers)
    return [cut.with_frame("ltl_yw", charges.filter(F.col("_window") == i).drop("_window")) for i in range(len(windows))]


def _runs_706(inputs, windows):
    """Runs of both 706 jobs: (run, its output). Several windows read the histories once, for slices that hold their rows."""
    cuts = _cut_706(inputs, windows) if len(windows) > 1 else [inputs]
    for (first, last), inputs in zip(windows, cuts):
        run_date = last + dt.timedelta(days=2)
        yield (r := _run("rule_706_input", first, last, run_date, 5, None)), rule_706.bol_input(inputs, first, last, r.audit)
        yield (r := _run("rule_706", first, last, run_date, 6)), rule_706.rule_706(inputs["flags"], first, last, run_date, r.audit)


def _runs_of_the_year(inputs):
    """One run of each of the other jobs; combine takes the feeds that the runs before it wrote (sent to this generator)."""
    feeds = {"706": feed_706(inputs)}
    feeds["702"] = yield (r := _run("rule_702", START, END, TEST_AS_OF, 7)), rule_702.rule_702(inputs, START, END, TEST_AS_OF, TP.rule_702, r.audit)
    feeds["710"] = yield (r := _run("rule_710", START, END, TEST_AS_OF, 8)), rule_710.run_rule_710(inputs, START, END, TEST_AS_OF, TP.rule_710, r.audit)
    yield (r := _run("combine", START, END, TEST_AS_OF, 9)), combine.combine_frames(feeds, "702,706,710", r.audit).frame


def _logged(inputs, windows_706) -> DataFrame:
    """The run log of all five jobs: each output is computed once, and its row holds what was observed on the way."""
    spark = inputs["flags"].sparkSession
    rows = []
    for runs in (_runs_706(inputs, windows_706), _runs_of_the_year(inputs)):
        written = None
        while (following := _next_run(runs, written)) is not None:
            run, out = following
            written = materialize(run.audit.written(out, run.amount))
            rows.append(run.row(spark))
    return reduce(DataFrame.unionByName, rows)


def _next_run(runs, written: DataFrame | None):
    """The next of `runs`, which is given the output written before; None at the end."""
    try:
        return runs.send(written)
    except StopIteration:
        return None


def _run_log(inputs) -> DataFrame:
    """Each job's newest five runs, the 706 jobs run month by month."""
    return runlog.latest_runs(_logged(inputs, _months()), 5).select(*runlog.REPORT_COLUMNS)


def _run_drops(inputs) -> DataFrame:
    """Rows that each exclusion took away, per job over the year."""
    drops = _logged(inputs, [(START, END)]).select("JOB", F.explode("DROPPED").alias("EXCLUSION", "ROWS"))
    return drops.groupBy("JOB", "EXCLUSION").agg(F.sum("ROWS").alias("ROWS_DROPPED"))


def _combine_tables(inputs) -> DataFrame:
    """Two feeds published as catalog tables and logged, the third rule never published; combined by the log."""
    spark = inputs["flags"].sparkSession
    tables = {rule: f"chargewise_feed_{rule}_{uuid.uuid4().hex}" for rule in ("702", "706", "710")}
    log_path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/chargewise-work/log-{uuid.uuid4().hex}"
    try:
        for rule, feed in (("702", feed_702), ("706", feed_706)):
            run = runlog.Run(f"rule_{rule}", START, END, TEST_AS_OF, tables[rule])
            with runlog.logged(spark, run, log_path) as audit:
                sinks.publish(audit.written(feed(inputs), run.amount), tables[rule])
        return combine.combine_tables(spark, "702,706,710", tables=tables, log=runlog.read_log(spark, log_path),
                                      windows={"702": (START, END)}).frame     # written before the tables go
    finally:
        remove(spark, log_path)
        for rule in ("702", "706"):
            spark.sql(f"DROP TABLE IF EXISTS {tables[rule]}")


def _returned(inputs):
    """The reviewers' file as CSV, with faults planted in some lines: read back and checked against what was sent."""
    spark, trk = inputs["flags"].sparkSession, F.col("TRACKING_NUMBER")
    text = inputs["flags"].select(*[F.col(c).cast("string").alias(c) for c in inputs["flags"].columns])
    total = F.col("TOTAL_CHARGE_AMT")
    faulty = text.withColumns({
        "TOTAL_CHARGE_AMT": F.when(trk.like("%7-2"), F.lit("n/a")).when(trk.like("%9-2"), F.lit("1.005"))
                             .when(trk.like("%8-1"), (total.cast("decimal(18,2)") + 1).cast("string")).otherwise(total),
        "PICKUP_DATE": F.when(trk.like("%3-1"), F.lit("1998-02-30")).otherwise(F.col("PICKUP_DATE")),
        "TRACKING_NUMBER": F.when(trk.like("%5-1"), F.concat(trk, F.lit("-x"))).otherwise(trk)})
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/chargewise-work/returned-{uuid.uuid4().hex}"
    faulty.write.option("header", "true").csv(path)
    return reviewer_file(spark, path, rule_706.bol_input(inputs, START, END))


def _rejects(inputs) -> DataFrame:
    return _returned(inputs).rejects.select(F.split("RECORD", ",")[0].alias("TRACKING_NUMBER"), "REASON")


def _weekly_top(inputs) -> DataFrame:
    """Top status from a state that starts with the first years and is merged with three weeks and the rest."""
    history = inputs["rel_status"]
    state = materialize(top_state.competing(top_state.until(history, START_STATE)))
    first = START_STATE
    for last in (*(START_STATE + dt.timedelta(days=7 * i) for i in (1, 2, 3)), dt.date(9999, 12, 30)):
        window = history.filter(dates.ts_within(F.col("status_ts"), first + dt.timedelta(days=1), last))
        state, first = top_state.merged(state, window, top_state.until(history, last)), last
    return rule_710.report(rule_710.top_status_of(inputs, state))


def _by_date(inputs, *relations: str):
    """The inputs with these histories stored by month."""
    spark = inputs[relations[0]].sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/chargewise-work/by-date-{uuid.uuid4().hex}"
    for relation in relations:
        layout.write_by_date(inputs[relation], relation, f"{root}/{relation}", "month")
    return layout.with_dates(inputs, {r: f"{root}/{r}" for r in relations}, spark)


def _without_ids(inputs) -> DataFrame:
    """W4: feeds without an id column; the rows are numbered."""
    feeds = {rule: materialize(feed(inputs).drop("PO_NUMBER")) for rule, feed in (("702", feed_702), ("710", feed_710))}
    return combine.combine_frames(feeds, "702,710").frame


def _from_lineage(inputs) -> DataFrame:
    """The feed's charges, summed from the lines behind them."""
    lines = rule_710.rule_710_lineage(inputs, START, END, TP.rule_710).filter(F.col("REASON") == rule_710.CHARGED)
    return lines.groupBy("PO_NUMBER", "AUDIT_COMMENTS").agg(F.sum("CHARGE").cast("double").alias("CHARGEBACK_AMOUNT"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_702": _q(feed_702),
    "rule_702_by_date": _q(lambda i: feed_702(_by_date(i, "fsc"))),
    "rule_706_input_by_date": _q(lambda i: rule_706.bol_input(_by_date(i, "ltl"), START, END)),
    "rule_710_by_date": _q(lambda i: feed_710(_by_date(i, "rel_status"))),
    "rule_706_input": _q(lambda i: rule_706.bol_input(i, START, END)),
    "rule_706": _q(feed_706),
    "top_status": _q(rule_710.top_status_report),
    "top_status_weekly": _q(_weekly_top),
    "latest_cancel": _q(lambda i: rule_710.latest_cancel(i).withColumn(
        "OMS_ORDER_CANCEL_QTY", F.col("OMS_ORDER_CANCEL_QTY").cast("decimal(18,2)"))),
    "unit_cost": _q(rule_710.unit_cost),
    "rule_710_exempt": _q(lambda i: rule_710.rule_710_exempt(i, START, END, TP.rule_710)),
    "rule_710_cancels": _q(lambda i: rule_710.rule_710_cancels(i, START, END, TP.rule_710)),
    "rule_710": _q(feed_710),
    "rule_710_lineage": _q(lambda i: rule_710.rule_710_lineage(i, START, END, TP.rule_710)),
    "rule_710_from_lineage": _q(_from_lineage),
    "combine": _q(combined),
    "combine_tables": _q(_combine_tables),
    "combine_without_ids": _q(_without_ids),
    "rule_706_returned": _q(lambda i: rule_706.rule_706(_returned(i).flags, START, END, TEST_AS_OF)),
    "rule_706_rejects": _q(_rejects),
    "rule_702_full_lists": _q(lambda i: rule_702.rule_702(full_list_inputs(i), START, END, TEST_AS_OF)),
    "rule_710_full_lists": _q(lambda i: rule_710.run_rule_710(full_list_inputs(i), START, END, TEST_AS_OF)),
    "run_log_top5": _q(_run_log),
    "run_log_drops": _q(_run_drops),
    "op_not_in_or": families.not_in_or,
    "op_null_tolerant_exclusion": families.null_tolerant_exclusion,
    "op_left_anti_null": families.left_anti_null,
    "op_distinct_wide_narrow": families.distinct_wide_narrow,
    "op_sum_null_parts": families.sum_null_parts,
    "op_week_window": families.week_window,
    "op_comment_builder": families.comment_builder,
    "op_dup_suffix": families.dup_suffix,
    "op_row_numbers": families.row_numbers,
    "op_aligned_union": families.aligned_union_q,
    "op_case_flag": families.case_flag,
}
