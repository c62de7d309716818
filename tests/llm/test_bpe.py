import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chargewise.llm import bpe
from tests.llm.conftest import AWKWARD

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "B", " ", "'s", "'LL", "é", "é", "İ", "ß", "²", "½", "1", "٣", "字", "́", "\x1c", "\xa0", "\x85", "\n", "!!", "_",
          "<|endoftext|>", "<|startoftext|>", "<|", "😀", "ǅ", "ſ", "Ω", "×", "ª", "Σ", "ΑΣ ", "\x00", "ﬁ", "Ⅷ"]


def compare(out, texts):
    tokenizer = Tokenizer.from_file(PATH)
    seen = sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), r["n_tokens"], r["text"]) for r in out)
    want = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((str(doc_id), ids, len(ids), tokenizer.decode(ids, skip_special_tokens=False)))
    assert seen == sorted(want)


def test_ids_and_texts_as_the_library(spark):
    rng = random.Random(2)
    texts = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30)))) for i in range(1500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    compare(bpe.encode(docs, PATH, chunk_chars=2000, buckets=5, decoded=True).collect(), texts)


def test_awkward_rows(awkward, empty):
    compare(bpe.decode(bpe.encode(awkward, PATH), PATH).collect(), [r[:2] for r in AWKWARD])
    assert bpe.encode(empty, PATH).collect() == []


def test_decoding_null_and_no_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, bytearray())], "doc_id long, ids binary")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(rows, PATH).collect()} == {1: None, 2: ""}
