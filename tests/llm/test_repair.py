import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chargewise.llm import repair as R
from chargewise.llm.common import scratch
from tests.llm.conftest import AWKWARD
from tests.llm.test_bpe import PIECES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_grammar_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 5000):
        for kinds in (1, 2, 5, 100):
            ids = np.repeat(rng.integers(0, kinds, n), rng.integers(1, 4, n)).astype(np.uint32)
            grammar = R.Grammar.unpack(R.compress(ids, pairs_per_round=8, min_count=2).pack())
            assert (grammar.expand() == ids).all()
            assert len(grammar.sequence) <= len(ids)
            if len(grammar.left):
                sizes = [len(grammar._unrolled(np.array([grammar.first + k]))) for k in range(len(grammar.left))]
                assert grammar.lengths.tolist() == sizes
            for _ in range(5):
                lo, hi = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
                assert (grammar.ids(lo, hi) == ids[lo:hi]).all()


def test_repetitive_ids_shrink():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    assert len(R.compress(ids).sequence) < len(ids) / 10


def round_trip(spark, docs, rows, **options):
    path = scratch(spark, "test-repair")
    R.write(docs, PATH, path, **options)
    tokenizer = Tokenizer.from_file(PATH)
    want = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0])
    out = sorted(R.documents(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    at, got = 0, {}
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
        got.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], "<u4").tolist())
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}
    return path


def test_files_hold_what_the_library_gives(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30)))) for i in range(1000)]
    path = round_trip(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows, shard_ids=500)
    tokenizer = Tokenizer.from_file(PATH)
    for doc_id, ids in R.look_up(spark, path, [3, 700, 999, 5000]):
        assert ids.tolist() == [*tokenizer.encode(rows[doc_id][1], add_special_tokens=False).ids, 0]


def test_awkward_rows(spark, awkward, empty):
    round_trip(spark, awkward, [r[:2] for r in AWKWARD])
    round_trip(spark, empty, [])


def test_known_words_are_looked_up_without_sorting_them(monkeypatch):
    """A batch whose words are all known costs a look-up in arrays: nothing is sorted or encoded again."""
    texts = ["Some words, some more words and 17 numbers.", "words and more numbers"]
    encoder = R.Encoder(PATH)
    first = encoder.encode(texts)

    def fail(*args, **kwargs):
        raise AssertionError

    monkeypatch.setattr(R.np, "unique", fail)
    monkeypatch.setattr(encoder.words, "encode", fail)
    assert encoder.encode(texts) == first


def test_a_full_word_table_is_emptied(monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(300)) for _ in range(20)]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for most in (100, 700, 100_000):            # smaller than a text's words, than all words, larger
        encoder = R.Encoder(PATH)
        encoder.known = R.Words(10 if most < 1000 else 17, most)       # places clash
        assert [encoder.encode([t])[0] for t in texts] == want
        assert encoder.encode(texts) == want and encoder.known.n <= most
