"""Job entry points, one per scheduled job.

Each computes the reporting window from the run date (the previous full
Sunday-Saturday week for rules 702 and 710), runs the rule, publishes its
output table (the old one stands until the new one is written and checked),
logs the run, also a failed one, and returns the published frame.

    python -m chargewise.jobs rule_710 --inputs-root /data/inputs --as-of 2025-08-04 --staging
    python -m chargewise.jobs combine --rules 702,710
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargewise import params as P
from chargewise import schemas
from chargewise.functions.dates import previous_week, rows_in
from chargewise.operators.working_set import expire, materialize, scoped
from chargewise.plans import combine, rule_702, rule_706, rule_710, runlog, top_state
from chargewise.session import tune
from chargewise.sources import sinks
from chargewise.sources.inputs import (Inputs, Reviewed, catalog_inputs, optional_table, parquet_inputs, reviewer_file,
                                       reviewer_flags)

OUT_702 = "DMC702_OUT"
STAGE_702 = "EXPEDITED_AUDIT"
STAGE_710_EXEMPT = "CANCELLATION_EXEMPT_QUERY"
STAGE_710_CANCELS = "CHARGEBACK_CANCELS_QUERY"
OUT_706_INPUT = "BOL_706_OFFSHORE_INPUT"
OUT_706 = "BOL_706_FINAL_OUTPUT"
LINEAGE_710 = "DMC710_LINEAGE"
REJECTS_706 = "BOL_706_REJECTS"
OUT_710 = "DMC710_OUT"
TOP_STATE = "OMS_TOP_STATUS_STATE"
WEEKLY_RULES = ("702", "710")


def _today(spark: SparkSession) -> dt.date:
    """The session's current day: windows and the stamp in the feed then agree."""
    return spark.range(1).select(F.current_date()).first()[0]


def _publish(run: runlog.Run, feed: DataFrame, schema: T.StructType, history: bool = False) -> DataFrame:
    """Write the run's output, check it and put it in place; with `history`, file it under its window too."""
    audited = run.audit.written(feed, run.amount)
    published = sinks.publish(audited, run.output, schema, [sinks.no_nulls(run.amount)] if run.amount else [])
    if history:
        sinks.keep_window(published, run.output, run.start, run.end)
    return published


@scoped
def run_rule_702(spark: SparkSession, inputs: Inputs, as_of: dt.date | None = None,
                 table: str = OUT_702, log_path: str | None = None,
                 p: P.Rule702Params = P.Rule702Params(), staging: bool = False, history: bool = False) -> DataFrame:
    """`staging=True` also keeps the audit rows the feed is built from, as a table; `history=True` every window's feed."""
    as_of = as_of or _today(spark)
    start, end = previous_week(as_of)
    run = runlog.Run("rule_702", start, end, as_of, table)
    with runlog.logged(spark, run, log_path) as audit:
        rows = rule_702.expedited_audit(inputs, start, end, p, audit)
        if staging:
            rows = sinks.publish(rows, STAGE_702)
        feed = rule_702.feed_from_audit(rows, as_of, p, audit)
        return _publish(run, feed, schemas.feed_schema(P.FEED_702_COLUMNS), history)


@scoped
def run_rule_706_input(spark: SparkSession, inputs: Inputs, start: dt.date, end: dt.date,
                       table: str = OUT_706_INPUT, log_path: str | None = None) -> DataFrame:
    """Step 1: the per-PRO table the reviewers flag."""
    run = runlog.Run("rule_706_input", start, end, _today(spark), table, amount=None)
    with runlog.logged(spark, run, log_path) as audit:
        return _publish(run, rule_706.bol_input(inputs, start, end, audit), schemas.BOL_INPUT)


@scoped
def run_rule_706(spark: SparkSession, flags: DataFrame, start: dt.date, end: dt.date,
                 as_of: dt.date | None = None, table: str = OUT_706,
                 log_path: str | None = None, history: bool = False, rejects: DataFrame | None = None) -> DataFrame:
    """Step 2: charge the rows the reviewers flagged. `rejects`: lines of their file that can't be used
    (`sources.inputs.reviewer_file`), published as a table of their own."""
    as_of = as_of or _today(spark)
    run = runlog.Run("rule_706", start, end, as_of, table)
    with runlog.logged(spark, run, log_path) as audit:
        if rejects is not None:
            sinks.publish(rejects, REJECTS_706)
        feed = rule_706.rule_706(flags, start, end, as_of, audit)
        audited = audit.written(feed, run.amount)       # a total may be missing (a NULL charge part)
        published = sinks.publish(audited, table, schemas.feed_schema(P.FEED_706_COLUMNS))
        if history:
            sinks.keep_window(published, table, start, end)
        return published


@scoped
def run_rule_710(spark: SparkSession, inputs: Inputs, as_of: dt.date | None = None,
                 table: str = OUT_710, log_path: str | None = None,
                 p: P.Rule710Params = P.Rule710Params(), staging: bool = False, history: bool = False,
                 lineage: bool = False) -> DataFrame:
    """`staging=True` also keeps the exemption list and the candidates as tables, `lineage=True` the lines behind each
    charge (`rule_710.rule_710_lineage`); `history=True` every window's feed."""
    as_of = as_of or _today(spark)
    start, end = previous_week(as_of)
    run = runlog.Run("rule_710", start, end, as_of, table)
    with runlog.logged(spark, run, log_path) as audit:
        week = rule_710.prepare_week(inputs, start, end, audit, narrow=True)
        rows = rule_710.candidate_rows(inputs, start, end, p, week, audit)
        exempt = rule_710.rule_710_exempt(inputs, start, end, p, week)
        if lineage:
            rows, exempt = materialize(rows), materialize(exempt)
            sinks.publish(rule_710.rule_710_lineage(inputs, start, end, p, week, rows, exempt), LINEAGE_710)
        cancels = rule_710.distinct_candidates(rows)
        if staging:
            exempt, cancels = sinks.publish(exempt, STAGE_710_EXEMPT), sinks.publish(cancels, STAGE_710_CANCELS)
        feed = rule_710.rule_710(cancels, exempt, as_of, p, audit)
        return _publish(run, feed, schemas.feed_schema(P.FEED_710_COLUMNS), history)


@scoped
def run_top_state(spark: SparkSession, inputs: Inputs, as_of: dt.date | None = None, table: str = TOP_STATE,
                  log_path: str | None = None) -> DataFrame:
    """Merge the reporting week's status rows into the top-status state; the first run ranks the whole history up to it."""
    as_of = as_of or _today(spark)
    start, end = previous_week(as_of)
    history = top_state.until(inputs["rel_status"], end)
    run = runlog.Run("top_state", start, end, as_of, table, amount=None)
    with runlog.logged(spark, run, log_path) as audit:
        state = optional_table(spark, table)
        if state is None:
            state = top_state.competing(audit.read(history))
        else:
            week = materialize(audit.read(rows_in(history, "status_ts", start, end)))
            state = top_state.merged(state, week, history)
        return _publish(run, schemas.conform(state, schemas.INPUTS["rel_status"]), schemas.INPUTS["rel_status"])


@scoped
def run_combine(spark: SparkSession, rules: str = "702,710", table: str = combine.COMBINED_TABLE,
                log_path: str | None = None, as_of: dt.date | None = None,
                tables: dict[str, str] | None = None) -> str:
    """Combine the rules' feeds; returns the status message.

    With a run log, the feeds must be whole and of the newest, successful runs, those of the weekly rules of the week before
    `as_of`; `StaleFeeds` is raised otherwise and the combined table stays as it was.
    """
    as_of = as_of or _today(spark)
    run = runlog.Run("combine", None, None, as_of, table)
    with runlog.logged(spark, run, log_path) as audit:
        known = runlog.read_log(spark, log_path) if log_path else None
        weekly = {rule: previous_week(as_of) for rule in WEEKLY_RULES}
        result = combine.combine_tables(spark, rules, tables=tables, log=known, windows=weekly, audit=audit)
        sinks.publish(audit.written(result.frame, run.amount if run.amount in result.frame.columns else None), table)
    return result.status(table)


def _inputs(spark: SparkSession, args) -> Inputs:
    if args.inputs_root:
        return parquet_inputs(spark, args.inputs_root)
    with open(args.catalog_map) as fh:
        return catalog_inputs(spark, json.load(fh))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="chargewise.jobs")
    ap.add_argument("job", choices=["rule_702", "rule_706_input", "rule_706", "rule_710", "top_state", "combine", "expire"])
    ap.add_argument("--inputs-root", help="folder holding one parquet folder per input relation")
    ap.add_argument("--catalog-map", help="JSON file mapping input relation names to catalog tables")
    ap.add_argument("--flags", help="reviewer flag file for rule 706")
    ap.add_argument("--flags-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--as-of", type=dt.date.fromisoformat)
    ap.add_argument("--start", type=dt.date.fromisoformat)
    ap.add_argument("--end", type=dt.date.fromisoformat)
    ap.add_argument("--rules", default="702,710")
    ap.add_argument("--run-log")
    ap.add_argument("--staging", action="store_true", help="also write the rules' staging tables")
    ap.add_argument("--days", type=float, default=14, help="expire: delete working sets that are older than this")
    ap.add_argument("--lineage", action="store_true", help="also write the lines behind each charge of rule 710")
    ap.add_argument("--history", action="store_true", help="also keep every window's feed, in <table>_HISTORY")
    args = ap.parse_args(argv)
    if args.job.startswith("rule_706") and (args.start is None or args.end is None):
        ap.error(f"{args.job} needs --start and --end")
    if args.job == "rule_706" and not args.flags:
        ap.error("rule_706 needs --flags")
    if args.job not in ("combine", "rule_706", "expire") and not (args.inputs_root or args.catalog_map):
        ap.error(f"{args.job} needs --inputs-root or --catalog-map")
    spark = tune(SparkSession.builder.getOrCreate())
    if args.job == "expire":
        print("\n".join(expire(spark, dt.timedelta(days=args.days))))
    elif args.job == "combine":
        print(run_combine(spark, args.rules, log_path=args.run_log, as_of=args.as_of))
    elif args.job == "rule_706":
        if args.flags_format == "csv":
            returned = reviewer_file(spark, args.flags, optional_table(spark, OUT_706_INPUT))
        else:
            returned = Reviewed(reviewer_flags(spark, args.flags, args.flags_format), None)
        run_rule_706(spark, returned.flags, args.start, args.end, args.as_of,
                     log_path=args.run_log, history=args.history, rejects=returned.rejects)
    elif args.job == "rule_706_input":
        run_rule_706_input(spark, _inputs(spark, args), args.start, args.end, log_path=args.run_log)
    elif args.job == "top_state":
        run_top_state(spark, _inputs(spark, args), args.as_of, log_path=args.run_log)
    elif args.job == "rule_702":
        run_rule_702(spark, _inputs(spark, args), args.as_of, log_path=args.run_log, staging=args.staging, history=args.history)
    else:
        run_rule_710(spark, _inputs(spark, args), args.as_of, log_path=args.run_log, staging=args.staging, history=args.history,
                     lineage=args.lineage)


if __name__ == "__main__":
    main()
