import base64
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargewise.llm import langid
from chargewise.llm.queries import op6_langid


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op6_langid(spark, sf).collect()
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert sum(r["rejected"] for r in rows) <= 0.002 * len(rows)


def test_awkward_rows(awkward, empty):
    out = langid.classify(awkward, langid.fit(awkward)).collect()
    assert len(out) == awkward.count()
    for r in out:
        letters = r["text"] is not None and langid.has_letter(r["text"])
        assert (r["lang_pred"] == langid.UNDETERMINED) == (not letters)
        assert letters or (r["rejected"] and r["score"] == 0)
    assert {r["lang_pred"] for r in out} <= {"en", "de", "zh", langid.UNDETERMINED}


def test_nothing_learned(awkward, empty):
    out = langid.classify(awkward, langid.fit(empty)).collect()
    assert {(r["lang_pred"], r["rejected"]) for r in out} == {(langid.UNDETERMINED, True)}
    assert langid.classify(empty, langid.fit(awkward)).collect() == []


def test_far_texts_are_rejected(spark):
    train = spark.createDataFrame([(f"the house and the garden number {i} of the town", "en") for i in range(40)]
                                  + [(f"das haus und der garten nummer {i} in der stadt", "de") for i in range(40)], "text string, lang string")
    model = langid.fit(train)
    names, scores, rejected = model.predict(["the house and the town", "das haus und der garten", "字漢語文書", "..."])
    assert names[:2] == ["en", "de"] and not rejected[:2].any()
    assert rejected[2:].all() and names[3] == langid.UNDETERMINED


FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja " \
    "heidän on toimittava toisiaan kohtaan veljeyden hengessä."


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_junk_and_unlearned_languages_are_rejected(spark, rng, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    held_out = langid.is_held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held_out))
    junk = [FINNISH, FINNISH * 20]
    for n in (20, 200, 2000):
        for letters in ("abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz"):
            junk += [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)) for _ in range(10)]
        junk += [base64.b64encode(rng.randbytes(5 * n)).decode() for _ in range(10)]
    assert model.predict(junk)[2].all()
    clean = [r["text"] for r in docs.where(held_out).select("text").collect()]
    clean += [t[:n] for t in clean for n in (40, 100, 400) if len(t) > n]
    assert model.predict(clean)[2].mean() <= 0.005


def test_copies_count_once_in_the_sample(spark):
    """Languages that are copies of a few texts are learned, and copies don't push other texts out."""
    german, french = "das haus und der garten in der stadt, nummer ", "la maison et le jardin de la ville, numero "
    rows = [(f"the house and the garden number {i} of the town", "en") for i in range(300)]
    rows += [("copy of one page about a river and a bridge", "en")] * 1500
    rows += [(f"{german}{i % 5}", "de") for i in range(2000)] + [(f"{french}{i % 5}", lang) for i in range(2000) for lang in ("fr", "fc")]
    train = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    model = langid.fit(train, sample=40)
    assert set(model.languages) == {"en", "de", "fr", "fc"}
    names, _, rejected = model.predict([german + "7", french + "7", "the house and the garden of the town"])
    assert names[0] == "de" and names[1] in ("fr", "fc") and names[2] == "en" and not rejected.any()
    assert langid.fit(train.distinct(), sample=40).languages == model.languages


def test_held_out_is_by_crc(spark):
    import zlib
    rows = spark.range(200).select("id", langid.is_held_out(F.col("id"), 7, 2).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 7 == 2) for r in rows)


def plain_counts(text):
    """n-gram counts by plain Python, before hashing."""
    raw = " " + " ".join("".join(chr(c).lower() if chr(c).isascii() and chr(c).isalpha() else chr(c) if c >= 128 else " "
                                 for c in text.encode()).split()) + " "
    grams = {}
    for n in (2, 3, 4):
        for i in range(len(raw) - n + 1):
            grams[raw[i:i + n]] = grams.get(raw[i:i + n], 0) + 1
    return grams


def test_model_against_a_plain_version(spark):
    """Document frequencies, the cosine and the prediction, computed with dictionaries and without the library's vectors."""
    rows = [(f"the house and the garden number {i} of the town {'by the sea' * (i % 3)}", "en") for i in range(30)]
    rows += [(f"das haus und der garten nummer {i} in der stadt {'am meer' * (i % 4)}", "de") for i in range(30)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3))

    def slot(gram):
        h = 0
        for c in gram:
            h = (h * 257 + ord(c)) % (1 << 32)
        return h * 2654435761 % (1 << 32) >> 32 - 13

    def hashed(text):
        out = {}
        for g, n in plain_counts(text).items():
            out[slot(g)] = out.get(slot(g), 0) + n
        return out

    seen = {}
    for text, _ in rows:
        for k in hashed(text):
            seen[k] = seen.get(k, 0) + 1
    idf = [math.log((1 + len(rows)) / (1 + seen.get(k, 0))) + 1 for k in range(langid.DIMS)]
    assert np.allclose(model.idf, idf, rtol=1e-5)
    for text in [rows[3][0], rows[40][0], "der garten", "a town by the sea", "zzz qqq"]:
        v = {k: math.log1p(n) * idf[k] for k, n in hashed(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        near = [sum(x / norm * float(c[k]) for k, x in v.items()) for c in model.centroids]
        names, scores, rejected = model.predict([text])
        best = max(range(len(near)), key=near.__getitem__)
        assert abs(scores[0] - max(0, near[best])) < 1e-5
        assert names[0] == model.languages[best] or near[best] - max(n for n, g in zip(near, model.languages) if g == names[0]) < 1e-5
        total = sum(hashed(text).values())
        own = [sum(n * float(f[k]) for k, n in hashed(text).items()) / total for f in model.frequencies]
        limits = [np.interp(math.log(total), np.log(langid.LENGTHS), limit) for limit in model.limits]
        assert rejected[0] == all(x < y for x, y in zip(own, limits))
    for c in model.centroids:                       # centroids are unit means of their language's texts
        assert abs(float((c * c).sum()) - 1) < 1e-5
