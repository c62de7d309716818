import hashlib
import re

import pytest
from pyspark.sql import functions as F

from chargewise.llm import fingerprint as fp
from chargewise.llm.common import read_table
from tests.llm.conftest import SF


def words_of(text):
    return [w for w in re.split("[\x20\t-\r]+", (text or "").lower()) if w]


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def sketches(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r["i"]: r["s"] for r in fp.with_sketch(df, "text", "s", **options).collect()}


def text_of(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_sketch_keeps_the_hashes_below_the_fraction(spark, rng):
    texts = [text_of(rng, n) for n in (3, 30, 68, 400, 6000)] + ["", "one", "a b c d e", "a b c d e " * 50]
    whole, kept = sketches(spark, texts, one_in=1), sketches(spark, texts)
    for i, t in enumerate(texts):
        every = whole[i]
        assert len(every) == len(shingles(t)) and every == sorted(every)
        below = [h for h in every if h < -(1 << 63) + (1 << 60)]
        assert kept[i] == (below if len(below) >= fp.FLOOR else every[:fp.FLOOR])
    assert len(kept[4]) > 300


def test_sketches_merge(spark, rng):
    a, b = text_of(rng, 900), text_of(rng, 50)
    one = sketches(spark, [a, b])
    both = spark.createDataFrame([(one[0], one[1])], "a array<long>, b array<long>").select(fp.merged(F.col("a"), F.col("b")).alias("m")).first()["m"]
    every = sorted(set(sketches(spark, [a, b], one_in=1)[0]) | set(sketches(spark, [a, b], one_in=1)[1]))
    below = [h for h in every if h < -(1 << 63) + (1 << 60)]
    assert both == (below if len(below) >= fp.FLOOR else every[:fp.FLOOR])


def test_estimates_follow_the_true_shares(spark, rng):
    """Containment of short texts in very long ones, and of texts that share a part."""
    pairs = []
    for size in (20, 60, 300, 2000):
        for share in (0.0, 0.3, 0.7, 1.0):
            own = text_of(rng, size)
            cut = " ".join(own.split()[:int(size * share)])
            pairs.append((own, text_of(rng, 30_000) + " " + cut))
            pairs.append((own, cut + " " + text_of(rng, size - int(size * share))))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, "a", "sa"), "b", "sb")
    got = {r["i"]: r for r in df.select("i", fp.containment(F.col("sa"), F.col("sb")).alias("c"),
                                        fp.resemblance(F.col("sa"), F.col("sb")).alias("r")).collect()}
    for i, (a, b) in enumerate(pairs):
        x, y = shingles(a), shingles(b)
        n = max(1, len(x) // 16 if len(words_of(b)) > 10_000 else min(len(x), 64))
        assert abs(got[i]["c"] - len(x & y) / len(x)) <= 2.5 * (0.25 / n) ** 0.5 + 0.02
        if len(words_of(b)) < 10_000:
            assert abs(got[i]["r"] - len(x & y) / len(x | y)) <= 2.5 * (0.25 / 64) ** 0.5 + 0.02


def slow_edits(rows):
    """(doc_id, sha of the edited text) of rows in order of doc_id."""
    out = []
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        out.append((d, len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("range_chars", [fp.RANGE_CHARS, 30_000])
def test_edited_texts_of_the_test_table(spark, monkeypatch, range_chars):
    monkeypatch.setattr(fp, "RANGE_CHARS", range_chars)     # one range, and many
    table = read_table(spark, SF, "documents").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"] or "") for r in table.collect())
    got = fp.edited(table.repartition(7)).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == slow_edits(rows)
    by_text, texts = {}, dict(rows)
    for r in got:
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    order = sorted(got, key=lambda r: r["doc_id"])
    assert len(set(r["fingerprint"] for r in got)) > 0.8 * len(by_text)
    for r, after in zip(order, order[1:] + order[:1]):
        x, y = shingles(texts[r["doc_id"]]), shingles(texts[after["doc_id"]])
        if r["fingerprint"] == after["fingerprint"]:
            assert r["near_next"] == r["alike_next"] == 1.0
        elif not x & y:
            assert r["near_next"] == 0.0
    assert sum(r["near_edited"] for r in got) / len(got) == pytest.approx(0.5, abs=0.1)


def test_awkward_rows(spark, awkward, empty):
    got = fp.edited(awkward).collect()
    assert len(got) == awkward.count() and fp.edited(empty).collect() == []
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    five = [r for r in got if r["doc_id"] == 5]             # the first of two equal rows has the other as its successor
    assert sorted(r["near_next"] for r in five)[-1] == 1.0 and len({r["fingerprint"] for r in five}) == 1
    alone = fp.edited(awkward.where("doc_id = 7")).collect()
    assert [r["near_next"] for r in alone] == [1.0]
    assert [r["fingerprint"] for r in got if r["doc_id"] in (1, 2, 3)] == [""] * 3


def test_main_path_is_native(spark, awkward):
    plan = fp.edited(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
