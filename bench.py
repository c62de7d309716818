"""Benchmark the chargeback jobs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each headline query runs into Spark's `noop` sink, which executes the whole
plan without collecting rows. One warm-up pass, which also derives and
stages the input relations from the test tables (not timed), then the
median of BENCH_RUNS timed runs per query. The window is a year; the
`_week` queries run one week, as in production. Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = ("rule_702", "rule_706_input", "rule_706", "rule_710", "rule_710_no_reduction", "combine",
            "rule_702_week", "rule_710_week")
EXTRA = ("rule_710_no_reduction", "rule_702_week", "rule_710_week")      # timed, not in the total
WEEK = (dt.date(1998, 6, 7), dt.date(1998, 6, 13))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    from chargewise import catalog_queries as CQ
    from chargewise.plans import rule_702, rule_710
    from chargewise.session import local_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2))))
    spark = local_session(cpus, shuffle_partitions=shuffle, app="chargewise-bench")

    def no_reduction(spark_, sf):
        inputs = CQ.inputs_for(spark_, sf)
        # Rank the whole status history, lazily, instead of the window's lines.
        history = inputs["rel_status"]
        top = rule_710.rank_top_status(inputs, rule_710.with_line_and_order(inputs, history))
        week = rule_710.Week(inputs, CQ.START, CQ.END, history, top, materialized=False)  # full tables
        cancels = rule_710.rule_710_cancels(inputs, CQ.START, CQ.END, CQ.TP.rule_710, week)
        exempt = rule_710.rule_710_exempt(inputs, CQ.START, CQ.END, CQ.TP.rule_710, week)
        return rule_710.rule_710(cancels, exempt, CQ.TEST_AS_OF, CQ.TP.rule_710)

    registry = dict(CQ.QUERIES)
    registry["rule_710_no_reduction"] = no_reduction
    registry["rule_702_week"] = lambda s, sf: rule_702.rule_702(CQ.inputs_for(s, sf), *WEEK, CQ.TEST_AS_OF, CQ.TP.rule_702)
    registry["rule_710_week"] = lambda s, sf: rule_710.run_rule_710(CQ.inputs_for(s, sf), *WEEK, CQ.TEST_AS_OF, CQ.TP.rule_710)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    errors = {}
    for name in names:  # warm-up: JIT, file listing, code generation, input staging
        try:
            run(name)
        except Exception as exc:  # report and keep measuring the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    samples = {name: [run(name) for _ in range(runs)] for name in names if name not in errors}
    timings = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    headline = [n for n in timings if n not in EXTRA]
    result = {
        "metric": "chargeback_jobs_total_sec",
        "value": round(sum(timings[n] for n in headline), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "shuffle_partitions": shuffle,
        "runs": runs,
        # min and max per query: run-to-run spread on a shared machine can be wide
        "spread": {name: [round(min(v), 3), round(max(v), 3)] for name, v in samples.items()},
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
