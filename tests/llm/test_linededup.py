from collections import defaultdict

import corpus_pipeline
from chargewise.llm import linededup as L
from tests.llm.conftest import AWKWARD


def slow(rows, least):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if site is not None:
                sites[line.strip(" ")].add(site)
    gone = {line for line, own in sites.items() if line and len(own) >= least}
    out = []
    for doc_id, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x.strip(" ") not in gone]
        out.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def compare(df, rows, least):
    got = L.remove_boilerplate(df, min_sites=least).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted((tuple(r) for r in got), key=str) == slow(rows, least)


def test_spread_against_sets(spark, rng):
    lines = [f"line {i}" for i in range(60)] + ["", "  ", " line 3 "]
    rows = [(i, "\n".join(rng.choice(lines[:rng.randint(1, 63)]) for _ in range(rng.randint(0, 12))),
             f"site{rng.randint(0, rng.randint(0, 40))}" if rng.random() < .9 else None) for i in range(400)]
    rows += [(1000 + i, "hot line\nown " + str(i), "site%d" % (i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for least in (2, 10, 20):
        compare(df, rows, least)


def test_awkward_rows(awkward, empty):
    for least in (1, 2, 3):
        compare(awkward, [(d, t, s) for d, t, _, s in AWKWARD], least)
    assert L.remove_boilerplate(empty).collect() == []
    assert set(awkward.columns) <= set(L.remove_boilerplate(awkward).columns)


def test_a_filter_on_the_text_has_it_computed_once(spark, awkward, empty):
    """Twice, each task holds two Python workers and two copies of the texts (the pipeline's second stage)."""
    docs = awkward.selectExpr("doc_id", "text", "lang", "source", "length(text) n_chars")
    for df in (corpus_pipeline.line_dedup(spark, docs, ""), L.remove_boilerplate(awkward).where("text <> ''")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
    rows = [(i, f"shared line\n{own}", f"s{i}") for i, own in enumerate(["", " ", "own", "shared line"] * 4)]
    df = spark.createDataFrame([(*r, "en", 0) for r in rows], "doc_id long, text string, source string, lang string, n_chars long")
    got = corpus_pipeline.line_dedup(spark, df, "").select("doc_id", "text").collect()
    want = [(d, t) for d, t, _, gone in slow(rows, L.MIN_SITES) if not gone or t.strip(" ")]
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_text_is_hashed_once_not_for_each_of_its_lines(awkward):
    plan = L.remove_boilerplate(awkward)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert any("sha2(" in step for step in plan)
    assert [step for step in plan if "sha2(" in step and "pos#" in step] == []
