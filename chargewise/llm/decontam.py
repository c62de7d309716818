"""Benchmark decontamination: counted n-gram seeds, then Smith-Waterman alignment.

The test items are the stated query set. They are taken in blocks of at most `block_words` words, so
what a task holds (the block's vocabulary and seeds) is bounded; every block meets every document.

An item of m words matches where its best alignment scores at least `min_score` (s) of its own 2 m: with
M words matched, mismatches and gaps number at most 2 M - 2 s m. Each of them parts at most two matched words
that follow each other on both sides, so at least (1 - 2 (n - 1) (1 - s)) m - (n - 1) of the item's word
n-grams stand unbroken in the passage, at different places, and the passage has at most (3 - 2 s) m words.

1. Each item is sought by its n-grams, n the largest up to `seed_words` that leaves at least one unbroken
   (pairs for items of 6 words and more at 0.6, else single words). Up to half of that number, the n-grams
   that most items share, are left out, and so many fewer are asked for.
2. One pass over the documents looks the n-grams up and keeps the passages that hold enough of them. In those
   the item is aligned by Smith-Waterman over words (match 2, mismatch -1, gap -1). The score is the best
   alignment's share of the item's own score; a passage that can't reach `min_score` even if all its words
   that the item has were matched isn't aligned. So no match is lost, however often an item or its copies occur.

Words are lower-cased runs of characters other than ASCII white space, control and punctuation characters.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargewise.llm.common import batch, rows_of, slices_of, texts_of

SEED_WORDS = 3
MIN_SCORE = 0.6
BLOCK_WORDS = 500_000
STRETCH = 1_000_000

_FOLD = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))
_MATCH, _MISMATCH, _GAP = 2, -1, 1


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _row_maxima(item: np.ndarray, passage: np.ndarray):
    """The rows of the Smith-Waterman matrix, one item word at a time."""
    drop = _GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for w in item.tolist():
        best = np.maximum(row - _GAP, 0)
        np.maximum(best[1:], row[:-1] + np.where(passage == w, _MATCH, _MISMATCH), out=best[1:])
        row = np.maximum.accumulate(best + drop) - drop
        yield row


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best local alignment; start and end are places in the passage."""
    score, end, rows = 0, 0, 0
    for i, row in enumerate(_row_maxima(item, passage), 1):
        at = int(row.argmax())
        if row[at] > score:
            score, end, rows = int(row[at]), at, i
    if not score:
        return 0, 0, 0
    back = 0
    for row in _row_maxima(item[:rows][::-1], passage[:end][::-1]):
        at = int(row.argmax())
        if row[at] == score:
            back = at
            break
    return score, end - back, end


def _seed_length(m: int, seed_words: int, min_score: float) -> tuple[int, int]:
    """n and the number of n-grams that every match of an item of m words has unbroken."""
    for n in range(min(seed_words, m), 1, -1):
        least = math.ceil(m * (1 - 2 * (n - 1) * (1 - min_score)) - (n - 1) - 1e-9)
        if least > 0:
            return n, least
    return 1, max(1, math.ceil(m * min_score - 1e-9))


@dataclass
class Items:
    """A block of test items: word ids (0: no word of the block) and, per n-gram length, the n-grams they are sought by."""

    ids: list
    words: list[np.ndarray]
    vocabulary: dict[bytes, int]
    grams: dict[int, np.ndarray]                       # length -> sorted codes
    holders: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> offsets (one for each code and the end), items
    least: np.ndarray                                  # n-grams a passage must hold, of each item
    span: np.ndarray                                   # words a match has at most, of each item
    min_score: float

    @classmethod
    def of(cls, rows: list[tuple], seed_words: int, min_score: float) -> Items:
        vocabulary: dict[bytes, int] = {}
        words = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)], np.int64) for _, t in rows]
        least, own = np.ones(len(rows), np.int64), {}
        shared: dict[int, Counter] = defaultdict(Counter)
        for i, item in enumerate(words):
            if len(item):
                n, least[i] = _seed_length(len(item), seed_words, min_score)
                own[i] = n, Counter(_codes(item, n, len(vocabulary) + 1).tolist())
                shared[n].update(own[i][1].keys())
        found: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for i, (n, codes) in own.items():
            spare = int(least[i]) // 2
            for code in sorted(codes, key=lambda c: (-shared[n][c], c)):
                if codes[code] <= spare and shared[n][code] > 1:
                    spare -= codes[code]
                    least[i] -= codes[code]
                else:
                    found[n][code].append(i)
        return cls([i for i, _ in rows], words, vocabulary,
                   {n: np.array(sorted(c), np.int64) for n, c in found.items()},
                   {n: (np.cumsum([0] + [len(c[k]) for k in sorted(c)]), np.array([i for k in sorted(c) for i in c[k]], np.int64))
                    for n, c in found.items()},
                   least, np.array([math.floor(len(w) * (3 - 2 * min_score) + 1e-9) for w in words], np.int64), min_score)

    def read(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def hits(self, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the document and numbers of the n-grams that occur there."""
        if len(ids) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = ids > 0
        whole = inside[:len(ids) - n + 1].copy()
        for k in range(1, n):
            whole &= inside[k:len(ids) - n + 1 + k]
        at = np.flatnonzero(whole)
        if not len(at):
            return at, at
        code = ids[at]
        for k in range(1, n):
            code = code * (len(self.vocabulary) + 1) + ids[at + k]
        slot = np.minimum(np.searchsorted(self.grams[n], code), len(self.grams[n]) - 1)
        same = self.grams[n][slot] == code
        return at[same], slot[same]


def _codes(ids: np.ndarray, n: int, base: int) -> np.ndarray:
    code = ids[:len(ids) - n + 1].copy()
    for k in range(1, n):
        code = code * base + ids[k:len(ids) - n + 1 + k]
    return code


class Matcher:
    """Finds the items of a block that a text contains, exactly or edited."""

    def __init__(self, items: Items):
        self.items, self.min_score = items, items.min_score

    def passages(self, ids: np.ndarray):
        """(item, first word, end word) of passages that may hold the item: every match lies within one."""
        for n in self.items.grams:
            at, slot = self.items.hits(ids, n)
            for k in self._stretches(n, at, slot):
                yield from self._held(n, at[k], slot[k], len(ids))

    def _stretches(self, n: int, at: np.ndarray, slot: np.ndarray):
        """The hits in pieces of bounded work that overlap by the longest match."""
        offsets, span = self.items.holders[n][0], int(self.items.span.max())
        work = np.cumsum(offsets[slot + 1] - offsets[slot])
        lo = 0
        while lo < len(at):
            hi = max(int(np.searchsorted(work, (work[lo - 1] if lo else 0) + STRETCH, "right")),
                     int(np.searchsorted(at, at[lo] + 2 * span)))
            yield slice(lo, hi)
            lo = int(np.searchsorted(at, at[hi] - span, "right")) if hi < len(at) else len(at)

    def _held(self, n: int, at: np.ndarray, slot: np.ndarray, size: int):
        """(item, first word, end word) around hits close enough to be those of a match."""
        offsets, holders = self.items.holders[n]
        sizes = offsets[slot + 1] - offsets[slot]
        place = np.repeat(at, sizes)
        item = holders[np.arange(len(place)) + np.repeat(offsets[slot] - np.cumsum(sizes) + sizes, sizes)]
        enough = np.bincount(item, minlength=len(self.items.least)) >= self.items.least
        place, item = place[enough[item]], item[enough[item]]
        order = np.argsort(item, kind="stable")            # by item, then by place
        place, item = place[order], item[order]
        last = np.arange(len(item)) + self.items.least[item] - 1
        first = np.flatnonzero(last < len(item))
        last = last[first]
        near = (item[first] == item[last]) & (place[last] + n - place[first] <= self.items.span[item[first]])
        first, last = first[near], last[near]
        own, span = item[first], self.items.span[item[first]]
        los, his = np.maximum(place[last] + n - span, 0), np.minimum(place[first] + span, size)
        held = None
        for i, lo, hi in zip(own.tolist(), los.tolist(), his.tolist()):
            if held and held[0] == i and lo <= held[2] and held[2] - held[1] < 50 * len(self.items.words[i]) + 1000:
                held = i, held[1], hi
                continue
            if held:
                yield held
            held = i, lo, hi
        if held:
            yield held

    def matches(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item number, score, first word, end word) for each item found."""
        ids = self.items.read(words_of(text))
        found: dict[int, tuple[int, int, int]] = {}
        for i, lo, hi in self.passages(ids):
            item = self.items.words[i]
            m, passage = len(item), ids[lo:hi]
            # A match lies within `span` words; it can't match more than these hold.
            most = np.cumsum(np.concatenate(([0], np.isin(passage, item))))
            span = min(len(passage), int(self.items.span[i]))
            if (most[span:] - most[:len(most) - span]).max() < self.min_score * m - 1e-9:
                continue
            score, start, end = align(item, passage)
            if score and score >= self.min_score * _MATCH * m - 1e-9:
                found[i] = max(found.get(i, (0, 0, 0)), (score, lo + start, lo + end), key=lambda x: (x[0], -x[1]))
        return [(i, score / (_MATCH * len(self.items.words[i])), lo, hi) for i, (score, lo, hi) in sorted(found.items())]


def _blocks(items: DataFrame, seed_words: int, min_score: float, block_words: int):
    rows, size = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        size += len(words_of(r["text"]))
        if size >= block_words:
            yield Items.of(rows, seed_words, min_score)
            rows, size = [], 0
    if rows:
        yield Items.of(rows, seed_words, min_score)


def _matchers(items: DataFrame, min_score: float, seed_words: int, block_words: int):
    for block in _blocks(items, seed_words, min_score, block_words):
        if len(block.vocabulary) + 1 >= 1 << (62 // seed_words):
            raise ValueError("block_words is too large for this seed length")
        if block.vocabulary:
            yield Matcher(block)


def contaminated_pairs(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE,
                       seed_words: int = SEED_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): each document and item it contains, once per row.

    docs: (doc_id, text), items: (item_id, text). Null and empty texts match nothing. Repeated
    documents and repeated items each give their own rows, null ids stay null, an empty table on
    either side gives an empty result; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                        ("first_word", pa.int64()), ("end_word", pa.int64())])
    ddl = "doc_id long, item_id long, score double, first_word long, end_word long"
    texts, spark = texts_of(docs, "doc_id"), docs.sparkSession
    result = spark.createDataFrame([], ddl)
    for matcher in _matchers(items, min_score, seed_words, block_words):
        held = spark.sparkContext.broadcast(matcher)

        def run(batches, held=held):
            for b in batches:
                rows = [(doc_id, held.value.items.ids[i], score, lo, hi)
                        for doc_id, text in rows_of([b])
                        for i, score, lo, hi in held.value.matches(text)]
                yield batch(schema, list(zip(*rows)) if rows else [[]] * 5)

        result = result.unionByName(texts.mapInArrow(run, ddl))
    return result


def clean(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE,
          seed_words: int = SEED_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` (any columns) whose text contains no item; nulls and ties as in `contaminated_pairs`."""
    def finder(held):
        @F.arrow_udf("boolean")
        def leaks(texts: pa.Array) -> pa.Array:
            return pa.array([bool(held.value.matches(t)) for own in slices_of(texts) for t in own], pa.bool_())
        return leaks

    kept = docs
    for matcher in _matchers(items, min_score, seed_words, block_words):
        kept = kept.where(~finder(docs.sparkSession.sparkContext.broadcast(matcher))("text"))
    return kept
