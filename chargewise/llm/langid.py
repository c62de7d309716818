"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed character n-grams (UTF-8 bytes, 2 to 4, letters only). Each
language has several centroids (spherical k-means of its training texts), so a language whose texts
fall into several styles isn't averaged into one. A text gets the language of the most similar
centroid (cosine). It is rejected when it is further from every language than held-out training texts
and stretches of them of like length are; the distance is the mean surprise of its n-grams under the
language's own n-gram frequencies, as cosines of long texts of random letters reach those of real ones.

Document frequencies count every training document. The centroids and the rejection distance are
fitted on the `sample` distinct texts of smallest hash of each language (documented bound): copies
count once there, so every language with a labelled text is learned, and no task gets more. Every
document is classified on its whole text; the model is languages x (`clusters` + 1) x `DIMS` floats.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargewise.llm.common import batch, bounded, rows_of, slices_of

DIMS = 1 << 13
GRAMS = (2, 3, 4)
LENGTHS = (16, 64, 256, 1024)      # n-grams; the last stands for all longer texts too
UNDETERMINED = "und"
MAX_LANGUAGES = 1000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a text (DIMS floats); n-grams of white space only don't count."""
    raw = b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_FOLD).split()) + b" "
    total = np.zeros(DIMS, np.float32)
    if len(raw) < 3:
        return total
    for lo in range(0, len(raw), 1 << 20):       # a very long text in pieces
        data = np.frombuffer(raw[lo:lo + (1 << 20) + max(GRAMS) - 1], np.uint8).astype(np.uint32)
        gram = data
        for n in range(2, max(GRAMS) + 1):
            if len(data) < n:
                break
            gram = gram[:-1] * np.uint32(257) + data[n - 1:]
            if n in GRAMS:
                own = gram[:min(len(gram), 1 << 20)]
                slot = (own * np.uint32(2654435761)) >> np.uint32(32 - DIMS.bit_length() + 1)
                total += np.bincount(slot, minlength=DIMS)
    return total


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def vectors(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors of counts; a text without n-grams has the zero vector."""
    x = np.log1p(x) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=x, where=norm > 0)


def likelihoods(x: np.ndarray, frequencies: np.ndarray) -> np.ndarray:
    """Mean logarithm of the frequency of a text's n-grams, for counts (rows) and languages (columns)."""
    return (x @ frequencies.T) / np.maximum(x.sum(axis=1, keepdims=True), 1)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Up to k unit centroids: farthest-point starts, then assignment and mean in turns."""
    centres = [x.mean(axis=0)]
    for _ in range(k - 1):
        centres.append(x[np.argmin((x @ np.stack(centres).T).max(axis=1))])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(axis=1)
        used = np.unique(own)
        c = np.stack([x[own == i].mean(axis=0) for i in used])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMS), np.float32))
    languages: list[str] = field(default_factory=list)   # of each centroid
    frequencies: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMS), np.float32))    # logarithms, of each language
    limits: list[list[float]] = field(default_factory=list)    # least mean logarithm accepted, of each language at LENGTHS

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and whether the text is rejected, for each text."""
        named = [t if t is not None and has_letter(t) else None for t in texts]
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        languages, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for lo in range(0, len(texts), 256):
            part = named[lo:lo + 256]
            x = np.stack([counts(t or "") for t in part])
            length = np.log(np.maximum(x.sum(axis=1), 1))
            limits = np.stack([np.interp(length, np.log(LENGTHS), own) for own in self.limits], axis=1)
            far = (likelihoods(x, self.frequencies) < limits).all(axis=1)
            near = np.clip(vectors(x, self.idf) @ self.centroids.T, 0, 1)
            best = near.argmax(axis=1)
            for i, t in enumerate(part):
                languages.append(UNDETERMINED if t is None else self.languages[best[i]])
                if t is not None:
                    scores[lo + i] = near[i, best[i]]
                    rejected[lo + i] = far[i]
        return languages, scores, rejected


def _logarithms(total: np.ndarray) -> np.ndarray:
    """Logarithms of smoothed frequencies, from counts."""
    return np.log((total + 0.5) / (total.sum() + 0.5 * DIMS)).astype("<f4")


def _limits(texts: list[str], total: np.ndarray, slack: float) -> list[float]:
    """The least mean logarithm accepted at each of LENGTHS; each text is held out of the counts that it is measured by."""
    near: list[list[float]] = [[] for _ in LENGTHS]
    for i, text in enumerate(texts):
        parts = [text]
        for length in LENGTHS:
            size = max(1, length // len(GRAMS))
            if size < len(text):
                at = i * 7919 % (len(text) - size + 1)
                parts.append(text[at:at + size])
        x = np.stack([counts(t) for t in parts])
        sizes = x.sum(axis=1)
        slot = np.abs(np.log(np.maximum(sizes, 1))[:, None] - np.log(LENGTHS)).argmin(axis=1)
        value = likelihoods(x, _logarithms(total - x[0] if len(texts) > 1 else total)[None])[:, 0]
        for k in np.flatnonzero(sizes).tolist():
            near[slot[k]].append(float(value[k]))
    lows = [float(np.quantile(own, 0.005)) - slack if own else np.inf for own in near]
    least = np.minimum.accumulate(lows[::-1])[::-1]     # a shorter text is never held to a higher limit than a longer one
    seen = least[np.isfinite(least)]
    return np.where(np.isfinite(least), least, seen[-1] if len(seen) else 0.0).tolist()


def fit(train: DataFrame, clusters: int = 4, sample: int = 400, slack: float = 1.25) -> Model:
    """Learn from `train` (text, lang); rows with a null text or lang don't count.

    `sample`: distinct texts per language that the centroids and limits are fitted on, at most. `slack`: a
    text is rejected where its mean logarithm is below what 99.5 % of those texts, each held out, and
    stretches of them of like length reach, by more than this.
    """
    train = bounded(train).select("text", "lang").where("text is not null and lang is not null")
    place = F.shiftrightunsigned(F.xxhash64("text"), 1)
    found = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(place).alias("texts")).limit(MAX_LANGUAGES + 1).collect()
    sizes = {r["lang"]: r["n"] for r in found}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages: is lang a language column?")
    if not sizes:
        return Model(np.ones(DIMS, np.float32))

    def frequencies(batches):
        seen = np.zeros(DIMS, np.int64)
        for b in batches:
            for (t,) in rows_of([b]):
                seen += counts(t) > 0
        slots = np.flatnonzero(seen)
        yield batch(pa.schema([("slot", pa.int32()), ("n", pa.int64())]), [slots.astype(np.int32), seen[slots]])

    df = np.zeros(DIMS, np.int64)
    for r in train.select("text").mapInArrow(frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        df[r["slot"]] = r["n"]
    idf = (np.log((1 + sum(sizes.values())) / (1 + df)) + 1).astype(np.float32)

    # Texts under twice the hash that `sample` of them are expected to have hold the `sample` smallest (the estimate is
    # good to some 5 %, a small language is taken whole); only those are folded and ranked.
    bound = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min((1 << 63) - 1, int((2 * sample + 100) / max(1, r["texts"]) * (1 << 63)))))
                         for r in found])
    distinct = train.withColumn("place", place).where(F.col("place") <= bound).groupBy("lang", "place", "text").agg(F.lit(1).alias("one"))
    smallest = Window.partitionBy("lang").orderBy("place", "text")
    chosen = distinct.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= sample).select("lang", "n", "text")

    def centroids(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in rows.sort_values("n")["text"] if has_letter(t)] or [""]
        x = np.stack([counts(t) for t in texts])
        total = x.sum(axis=0, dtype=np.float64)
        frequencies, limits = _logarithms(total), _limits(texts, total, slack)
        x = vectors(x, idf)
        c = spherical_kmeans(x, min(clusters, len(x)))
        return pd.DataFrame({"lang": key[0], "centroid": [v.astype("<f4").tobytes() for v in c],
                             "frequencies": [frequencies.tobytes()] + [None] * (len(c) - 1), "reach": [limits] + [None] * (len(c) - 1)})

    rows = chosen.groupBy("lang").applyInPandas(centroids, "lang string, centroid binary, frequencies binary, reach array<double>").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["centroid"])))
    if not rows:
        return Model(idf)
    whole = [r for r in rows if r["frequencies"] is not None]
    return Model(idf, np.stack([np.frombuffer(r["centroid"], "<f4") for r in rows]), [r["lang"] for r in rows],
                 np.stack([np.frombuffer(r["frequencies"], "<f4") for r in whole]), [list(r["reach"]) for r in whole])


def classify(docs: DataFrame, model: Model, names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """`docs` with lang_pred, score (0 to 1) and rejected (or as `names` calls them) added, from its column text alone.

    A null text, or one without a letter, is `und`, score 0 and rejected; so is every text if the
    model learned nothing. Columns of those names in `docs` are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)    # bounded: see MAX_LANGUAGES and DIMS

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pa.Array) -> pa.Array:
        parts = [held.value.predict(own) for own in slices_of(texts)] or [([], [], [])]
        columns = [pa.array([x for p in parts for x in p[i]], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
        return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "rejected"])

    found = bounded(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predict("text").alias("language"))
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in names],
                        *[F.col(f"language.{given}").alias(name) for given, name in zip(("lang_pred", "score", "rejected"), names)])


def is_held_out(doc_id, parts: int = 5, rest: int = 0):
    """Whether crc32 of the id as text leaves `rest` modulo `parts`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == rest
