"""Summarise the physical plans of the weekly jobs.

    python tools/plan_report.py [--sf /root/testdata/sf0.1] [--limit 1MB]

Runs rules 702, 706 and 710 for one reporting week with the broadcast limit
lowered below the size of every staged history table (as in production,
where histories are far larger than a week's slice). For every written
working set and every final plan it prints each scan (table, pushed filters,
columns read) and the operator the scan feeds into first: a broadcast semi
join (filtered map-side) or a shuffle Exchange.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import re
import sys
import threading

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.plans import METADATA_LENGTH, plan_text, scans  # noqa: E402

WEEK = (dt.date(1998, 6, 7), dt.date(1998, 6, 13))


def plan_text(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def report_lines(df) -> list[str]:
    formatted = plan_text(df, "formatted")
    pushed = {}
    for block in formatted.split("\n\n"):
        m = re.search(r"Location: InMemoryFileIndex \[[^\]]*/([\w-]+)\]", block)
        if m and "Scan parquet" in block:
            pf = re.search(r"PushedFilters: (\[.*?\])\n", block)
            rs = re.search(r"ReadSchema: struct<(.*?)>", block)
            cols = ",".join(c.split(":")[0] for c in rs.group(1).split(",")) if rs else ""
            pushed.setdefault(m.group(1), set()).add((pf.group(1) if pf else "[]", cols))
    out = {f"{table:>14} -> {above}" + ", pruned by a bloom filter" * any("might_contain" in x for x in between)
           for table, above, between in scans(plan_text(df))}
    details = [f"{t:>14}    pushed {pf}  reads {cols}" for t, vals in sorted(pushed.items()) for pf, cols in sorted(vals)
               if not re.fullmatch(r"[0-9a-f]{32}", t)]
    return sorted(out) + details


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--limit", default="1MB")
    args = ap.parse_args()
    from chargewise import catalog_queries as CQ
    from chargewise.operators import working_set
    from chargewise.plans import rule_702, rule_706, rule_710
    from chargewise.session import local_session

    spark = local_session(8, 16)
    inputs = CQ.inputs_for(spark, args.sf)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, args.limit)
    spark.conf.set(METADATA_LENGTH, "1000")  # keep scan locations whole
    original = working_set.materialize
    step = [0]

    def report(title, df):
        print(f"\n## {title}")
        for line in report_lines(df):
            print("   " + line)

    lock = threading.Lock()  # some slices are written from two threads; explain() output is captured globally

    def spy(df):
        with lock:
            step[0] += 1
            report(f"working set {step[0]}", df)
        return original(df)

    for module in (rule_702, rule_706, rule_710):
        module.materialize = spy
    start, end = WEEK
    print(f"# window {start} .. {end}, broadcast limit {args.limit}, inputs {args.sf}")
    print("\n# rule_702")
    report("rule_702 final", rule_702.rule_702(inputs, start, end, None, CQ.TP.rule_702))
    print("\n# rule_706_input")
    report("rule_706_input final", rule_706.bol_input(inputs, start, end))
    print("\n# rule_710")
    week = rule_710.prepare_week(inputs, start, end)
    feed = rule_710.rule_710(rule_710.rule_710_cancels(inputs, start, end, CQ.TP.rule_710, week),
                             rule_710.rule_710_exempt(inputs, start, end, CQ.TP.rule_710, week),
                             CQ.TEST_AS_OF, CQ.TP.rule_710)
    report("rule_710 final", feed)
    spark.stop()


if __name__ == "__main__":
    main()
