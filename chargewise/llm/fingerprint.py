"""Threshold-scaled document fingerprints, in DataFrame functions alone.

A text's fingerprint is the set of its shingle hashes (five words, lower case) below a fixed fraction
(1/16) of the hash range. Unlike a sketch of fixed size it grows with the text, so the share of a short
text that a long one holds can be read off the two fingerprints. Where fewer than FLOOR hashes lie below the
fraction, the FLOOR smallest are kept: short texts are kept whole, and every fingerprint says up to
which hash it is complete. Both rules depend on the set of hashes alone, so fingerprints merge: that
of several texts together is found from theirs (`merged`).

`fingerprints` is a projection, without a shuffle. `with_next` deals the rows over ranges of doc_id, of
about equal size; the first row of each range is also sent to the range before it, so each row finds
its successor within its range, by one shuffle of the texts.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
ONE_IN = 16
FLOOR = 64
RANGE_CHARS = 4 << 20      # characters of a range of doc_id, while there are no more than MAX_RANGES
MAX_RANGES = 1 << 16

_LEAST = -(1 << 63)


def _last(one_in: int) -> int:
    """Of the signed hashes, one in `one_in` lies at or below this."""
    return _LEAST + (1 << 64) // one_in - 1


def with_sketch(df: DataFrame, text: str, name: str, words: int = WORDS, one_in: int = ONE_IN, floor: int = FLOOR) -> DataFrame:
    """`df` with the fingerprint of column `text` (no null): an ascending array of distinct 64-bit hashes.

    Steps are columns of their own, so that each is computed once: `name` and names that begin with it must be free.
    """
    each, all_ = f"{name}_words", f"{name}_hashes"
    w = F.filter(F.split(F.lower(F.col(text)), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    df = df.withColumn(each, F.transform(w, lambda x: F.xxhash64(x)))
    n = F.size(each)
    shingles = F.transform(F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(*[F.get(F.col(each), i + k) for k in range(words)]))
    short = F.array(F.aggregate(each, F.lit(42).cast("long"), lambda h, x: F.xxhash64(h, x)))
    hashes = F.when(n >= words, shingles).when(n > 0, short).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(all_, F.sort_array(F.array_distinct(hashes)))
    return df.withColumn(name, _kept(F.col(all_), one_in, floor)).drop(each, all_)


def _kept(ascending: Column, one_in: int, floor: int) -> Column:
    below = F.size(F.filter(ascending, lambda h: h <= F.lit(_last(one_in))))
    return F.slice(ascending, 1, F.greatest(below, F.lit(floor)))


def merged(a: Column, b: Column, one_in: int = ONE_IN, floor: int = FLOOR) -> Column:
    """The fingerprint of two texts' shingles together, from their fingerprints."""
    return _kept(F.sort_array(F.array_union(a, b)), one_in, floor)


def _complete_to(sketch: Column, one_in: int, floor: int) -> Column:
    """The largest hash up to which a fingerprint holds all hashes of its text."""
    return F.when(F.size(sketch) < floor, F.lit((1 << 63) - 1)).otherwise(
        F.greatest(F.lit(_last(one_in)), F.element_at(sketch, -1)))


def _compared(a: Column, b: Column, one_in: int, floor: int) -> tuple[Column, Column, Column]:
    """Numbers of hashes of a, of b and of both, as far as both fingerprints are complete."""
    up_to = F.least(_complete_to(a, one_in, floor), _complete_to(b, one_in, floor))

    def seen(x):
        return F.size(F.filter(x, lambda h: h <= up_to))

    return seen(a), seen(b), seen(F.array_intersect(a, b))


def containment(a: Column, b: Column, one_in: int = ONE_IN, floor: int = FLOOR) -> Column:
    """Estimated share of a's shingles that b holds too; two texts without a word hold each other."""
    of_a, _, both = _compared(a, b, one_in, floor)
    share = F.when(of_a > 0, both / of_a).otherwise(F.lit(0.0))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(share)


def resemblance(a: Column, b: Column, one_in: int = ONE_IN, floor: int = FLOOR) -> Column:
    """Estimated share of the shingles of both texts that they have in common."""
    of_a, of_b, both = _compared(a, b, one_in, floor)
    total = of_a + of_b - both
    share = F.when(total > 0, both / total).otherwise(F.lit(0.0))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(share)


def as_text(sketch: Column) -> Column:
    """A fingerprint as hex digits, 16 for each hash, ascending."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, sketch) of every row of `docs` (doc_id, text).

    A null text counts as empty. A text of one to four words has one shingle, all of them; one without a word
    none. Repeated rows keep their own result, equal texts have equal fingerprints, long texts are
    taken whole; an empty table gives an empty result; other columns are ignored, whatever their names.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return with_sketch(texts, "text", "sketch").select("doc_id", F.length("text").cast("long").alias("n_chars"), "sketch")


# --- each document's successor

def _key() -> Column:
    """Order of documents: by doc_id (null first), then by a hash of the text."""
    return F.struct(F.col("doc_id").isNotNull().alias("b"), F.coalesce(F.col("doc_id"), F.lit(0).cast("long")).alias("i"),
                    F.xxhash64("text").alias("h"))


def _range_starts(texts: DataFrame) -> list:
    """The least key of each range of documents, ascending; at most MAX_RANGES."""
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first()["n"]
    if chars is None:
        return []
    ranges = max(1, min(MAX_RANGES, math.ceil(chars / RANGE_CHARS)))
    keys = texts.select(_key().alias("key")).select("key.*").repartitionByRange(ranges, "b", "i", "h")
    least = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("b", "i", "h")).alias("key"))
    return sorted(tuple(r["key"]) for r in least.collect())


def with_next(texts: DataFrame, payload: list[str]) -> DataFrame:
    """`texts` (doc_id, text, payload) and, as next_<name>, the payload columns of each row's successor.

    The successor of the last document is the first. Rows equal in doc_id and text follow each other.
    The starts of the ranges (at most MAX_RANGES keys) pass through the driver.
    """
    starts = _range_starts(texts)
    if not starts:
        return texts.select("*", *[F.col(c).alias(f"next_{c}") for c in payload])
    known = F.from_json(F.lit(json.dumps([{"b": b, "i": i, "h": h} for b, i, h in starts])), "array<struct<b:boolean,i:bigint,h:bigint>>")
    halved = F.struct(F.lit(0).alias("lo"), F.lit(len(starts)).alias("hi"))

    def step(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        after = F.get(known, mid) <= F.col("key")
        open_ = s["lo"] < s["hi"]
        return F.struct(F.when(open_ & after, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(open_ & ~after, mid).otherwise(s["hi"]).alias("hi"))

    steps = F.sequence(F.lit(0), F.lit(len(starts).bit_length()))
    placed = (texts.withColumn("key", _key()).withColumn("range", F.aggregate(steps, halved, step)["lo"])
              .withColumn("first", F.get(known, F.col("range") - 1) == F.col("key")))
    before = F.when(F.col("range") > 1, F.col("range") - 1).otherwise(F.lit(len(starts)))
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("guest"))
    guest = F.struct(before.alias("range"), F.lit(1).alias("guest"))
    dealt = (placed.withColumn("in", F.explode(F.when(F.col("first"), F.array(own, guest)).otherwise(F.array(own))))
             .select(*texts.columns, "key", "in.range", "in.guest"))
    order = Window.partitionBy("range").orderBy("guest", "key")
    found = dealt.withColumn("next", F.lead(F.struct(*payload)).over(order)).where("guest = 0")
    return found.select(*texts.columns, *[F.col(f"next.{c}").alias(f"next_{c}") for c in payload])


def edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text and how alike they are.

    The edited text is the text with its last half (rounded down, in code points) replaced by as much of the beginning of the
    next document. near_edited, near_next: the share of the document's shingles that the edited text, the next document
    hold (`containment`); alike_edited, alike_next: `resemblance`. Nulls, repeated rows, short and empty texts as in
    `fingerprints` and `with_next`; a single document is its own successor.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pairs = with_next(with_sketch(texts, "text", "sketch"), ["text", "sketch"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = pairs.withColumn("n_chars", n).withColumn(
        "edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    pairs = with_sketch(pairs, "edited", "edited_sketch")
    own, changed, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return pairs.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
        containment(own, changed).alias("near_edited"), containment(own, after).alias("near_next"),
        resemblance(own, changed).alias("alike_edited"), resemblance(own, after).alias("alike_next"))
