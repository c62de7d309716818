import numpy as np

from chargewise.llm import decontam as D
from tests.llm.conftest import AWKWARD


def slow_align(item, passage):
    table = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if a == b else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    return int(table.max())


def test_alignment_against_the_full_table(rng):
    for _ in range(200):
        item, passage = ([rng.randrange(6) for _ in range(rng.randint(1, 12))] for _ in range(2))
        score, start, end = D.align(np.array(item), np.array(passage))
        assert score == slow_align(item, passage)
        assert slow_align(item, passage[start:end]) == score


def test_copies_exact_and_edited(spark, rng):
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(15, 40)))) for i in range(20)]
    filler = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs, want = [], set()
    for d in range(300):
        words = filler(rng.randint(0, 300))
        if d % 3 == 0:
            i, text = items[rng.randrange(20)]
            own = text.split()
            for _ in range(len(own) // 10 if d % 2 else 0):
                own[rng.randrange(len(own))] = rng.choice(["changed", "other"])
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in own]
            want.add((d, i))
        docs.append((d, " ".join(words)))
    docs += [(1000 + k, items[0][1]) for k in range(150)]        # a leak into a third of all documents
    want |= {(1000 + k, 0) for k in range(150)}
    # Every pair by the full table: those at or over the limit, and no other.
    for d, text in docs[:60]:
        for i, item in items:
            share = slow_align(D.words_of(item), D.words_of(text)) / (2 * len(D.words_of(item)))
            assert (share >= D.MIN_SCORE) == ((d, i) in want)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    for block in (D.BLOCK_WORDS, 100):
        got = D.contaminated_pairs(table, tests, block_words=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    assert {r["doc_id"] for r in D.clean(table, tests).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def edited(rng, own, every, kind):
    out = []
    for k, w in enumerate(own, 1):
        if k % every:
            out.append(w)
        elif kind != "drop":
            out += [w, rng.choice("xyz")] if kind == "insert" else [rng.choice("xyz")]
    return out


def test_dense_edits_with_and_without_an_exact_copy(spark, rng):
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(15, 60)))) for i in range(16)]
    edits = [(n, "replace") for n in (4, 5, 6)] + [(n, "drop") for n in (4, 5)] + [(n, "insert") for n in (2, 3)]
    docs = []
    for i, text in items:
        for every, kind in edits:
            filler = [rng.choice(vocabulary) for _ in range(40)]
            docs.append((len(docs), " ".join(filler[:20] + edited(rng, text.split(), every, kind) + filler[20:])))
        docs += [(len(docs) + k, text) for k in range(0 if i % 2 else 3)]
    want = {(d, i) for d, text in docs for i, item in items
            if slow_align(D.words_of(item), D.words_of(text)) >= D.MIN_SCORE * 2 * len(D.words_of(item))}
    assert len(want) >= len(items) * len(edits)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated_pairs(table, tests).collect()} == want
    assert {r["doc_id"] for r in D.clean(table, tests).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_no_match_is_lost(rng, monkeypatch):
    for stretch in (D.STRETCH, 20):
        monkeypatch.setattr(D, "STRETCH", stretch)
        for least in (0.4, 0.6, 0.7, 0.85, 1.0):
            for words in (4, 30):
                items = [(i, " ".join(str(rng.randrange(words)) for _ in range(rng.randint(1, 25)))) for i in range(12)]
                matcher = D.Matcher(D.Items.of(items, D.SEED_WORDS, least))
                for _ in range(15):
                    text = " ".join(str(rng.randrange(words + 2)) for _ in range(rng.randint(0, 60)))
                    own = rng.choice(items)[1].split()
                    text += " " + " ".join(edited(rng, own, rng.randint(2, 8), rng.choice(["replace", "drop", "insert"])))
                    scores = [slow_align(D.words_of(item), D.words_of(text)) / (2 * len(D.words_of(item))) for _, item in items]
                    got = {i: score for i, score, _, _ in matcher.matches(text)}
                    assert got == {i: s for i, s in enumerate(scores) if s >= least - 1e-9}


def test_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(1, None), (None, "same text twice same text twice"), (3, ""), (4, "café"), (4, "café"), (5, "long " * 50)],
                                  "item_id long, text string")
    got = sorted(str((r["doc_id"], r["item_id"])) for r in D.contaminated_pairs(awkward, items).collect())
    copies = [d for d, t, _, _ in AWKWARD if t and t.startswith("Same")]
    assert got == sorted(map(str, [(d, i) for d in copies for i in (None, 4, 4)] + [(7, 5)]))
    assert D.clean(awkward, items).count() == len(AWKWARD) - len(copies) - 1
    assert D.contaminated_pairs(empty, items).collect() == [] and D.contaminated_pairs(awkward, items.limit(0)).collect() == []
    assert D.clean(empty, items).collect() == [] and D.clean(awkward, items.limit(0)).count() == len(AWKWARD)
