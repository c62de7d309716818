"""Token ids in files compressed by a Re-Pair grammar per shard.

Documents are range-partitioned and sorted by doc_id, encoded, and cut into shards of about
`shard_ids` ids (whole documents). In a shard the most frequent pairs of neighbouring symbols are
replaced by nonterminals, again and again, until that gains little. A shard row holds the document
ids and lengths, the rules, each rule's expansion length and the remaining sequence. The lengths make
random access possible: a range of ids is decoded from the few symbols that cover it.

The files are a Parquet table (one row per shard) in a folder that all machines share; writing it is
a Spark job, so a lost task is run again and leaves no half-written shard. Nothing is global but the
number of ids per partition, which gives each shard its place in the whole.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargewise.llm.bpe import load
from chargewise.llm.common import batch, pack, rows_of, run_hashes, texts_of, unpack
from chargewise.llm.wordbpe import MAX_BYTES, WordBpe

SHARD_IDS = 1 << 20
PAIRS_PER_ROUND = 1024
MAX_ROUNDS = 8
MIN_COUNT = 4
MIN_GAIN = 0.02
_CACHE_WORDS = 700_000

# Texts of these characters only are split here, to the words of the byte-level pre-tokenizer.
_PLAIN = re.compile("[\t-\r -~À-ɏ]*")
_LETTER, _DIGIT, _SPACE, _OTHER, _END = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0xCA)]] = _LETTER      # bytes of À to ɏ, but for × and ÷
_CLASS[[*range(48, 58)]] = _DIGIT
_CLASS[[*range(9, 14), 32]] = _SPACE
_CLASS[0] = _END


def plain_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of plain texts, each followed by a zero byte.

    Words are runs of letters, of digits or of other characters, with one blank before them if there is one; 's 't 're 've
    'm 'll 'd; and what white space is left.
    """
    kind = _CLASS[data]
    sign = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    kind[sign] = kind[sign + 1] = _OTHER
    n = len(data)
    cut = np.ones(n + 1, bool)
    cut[1:n] = kind[1:] != kind[:-1]
    ends_space = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _END))     # last of a run before a word
    cut[ends_space] = True                              # it leaves the run
    cut[ends_space[data[ends_space] == 32] + 1] = False  # and a blank joins the word
    # Contractions: an apostrophe alone, without a blank before it, and the letters behind it.
    quote = np.flatnonzero((data[:-2] == 39) & cut[:n - 2] & cut[1:n - 1] & (kind[1:n - 1] == _LETTER))
    one, two = data[quote + 1], data[np.minimum(quote + 2, n - 1)]
    size = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
    size[(two == 101) & ((one == 114) | (one == 118)) | (two == 108) & (one == 108)] = 2
    quote, size = quote[size > 0], size[size > 0]
    cut[quote + 1] = False
    cut[quote + 1 + size] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    real = data[starts] != 0
    return starts[real], ends[real]


class Words:
    """Ids of words by the words' hashes: a hash table in arrays, where a whole batch is looked up at once.

    Words whose places clash follow each other from there. When the table is full it is emptied, so memory is bounded.
    """

    def __init__(self, bits: int = 21, most: int = _CACHE_WORDS):
        self.bits, self.most, self.n = bits, most, 0
        self.keys = np.zeros(1 << bits, np.uint64)          # 0: a free place
        self.begin, self.size = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        place = self._first(hashes)
        found = self.keys[place]
        place[found == 0] = -1
        at = np.flatnonzero((found != 0) & (found != hashes))
        while len(at):
            place[at] = (place[at] + 1) & ((1 << self.bits) - 1)
            found = self.keys[place[at]]
            place[at[found == 0]] = -1
            at = at[(found != 0) & (found != hashes[at])]
        return place

    def add(self, hashes: np.ndarray, encoded: list[bytes]) -> None:
        """Words that the table doesn't hold, each once, with their ids."""
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) >> 2
        ids = np.frombuffer(b"".join(encoded), "<u4")
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[:self.used], np.zeros(self.used + 2 * len(ids), np.uint32)))
        self.ids[self.used:self.used + len(ids)] = ids
        begin, place, at = self.used + np.cumsum(sizes) - sizes, self._first(hashes), np.arange(len(hashes))
        while len(at):
            free = at[self.keys[place[at]] == 0]
            self.keys[place[free]] = hashes[free]           # of those at one place the last stays
            at = at[self.keys[place[at]] != hashes[at]]
            place[at] = (place[at] + 1) & ((1 << self.bits) - 1)
        self.begin[place], self.size[place] = begin, sizes
        self.used, self.n = self.used + len(ids), self.n + len(hashes)

    def has_room(self, n: int) -> bool:
        return self.n + n <= self.most

    def clear(self) -> None:
        self.keys[:], self.n, self.used = 0, 0, 0


class Encoder:
    """Ids of whole texts, as bytes (little-endian unsigned 32-bit).

    The ids of words are kept (`Words`), so a word seen lately isn't encoded again.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.words = WordBpe(path)
        self.known = Words()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        left = range(len(words))
        if self.words.usable:
            short = [i for i in left if len(words[i]) <= MAX_BYTES]
            for i, ids in zip(short, self.words.encode([words[i] for i in short])):
                out[i] = ids
            left = [i for i in left if len(words[i]) > MAX_BYTES]
        for i, e in zip(left, self.tokenizer.encode_batch([words[i].decode() for i in left], add_special_tokens=False)):
            out[i] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        return out

    def _places(self, raw: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[Words, np.ndarray]:
        """A table that holds all of the words, and the place of each."""
        known = self.known
        place = known.find(hashes)
        new = np.flatnonzero(place < 0)
        if not len(new):
            return known, place
        distinct, first = np.unique(hashes[new], return_index=True)
        if not known.has_room(len(distinct)):
            known.clear()
            distinct, first = np.unique(hashes, return_index=True)
            new = np.arange(len(hashes))
            if not known.has_room(len(distinct)):       # a batch of one huge text: a table of its own
                known = Words((2 * len(distinct)).bit_length(), len(distinct))
        first = new[first]
        known.add(distinct, self._ids_of([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]))
        place[new] = known.find(hashes[new])
        return known, place

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [bool(_PLAIN.fullmatch(t)) and not (self.special and self.special.search(t)) for t in texts]
        done = iter(self._plain([t.encode() for t, p in zip(texts, plain) if p]))
        return [next(done) if p else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                for t, p in zip(texts, plain)]

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of plain texts: their words are told apart by hashes, each new one is encoded once, and ids are gathered."""
        raw = b"".join([t + b"\0" for t in texts])
        data = np.frombuffer(raw, np.uint8)
        if len(data) < 3:
            return [b"".join(struct.pack("<I", i) for i in self.tokenizer.encode(t.decode(), add_special_tokens=False).ids) for t in texts]
        starts, ends = plain_words(data)
        hashes = run_hashes(data, starts, ends)
        hashes[hashes == 0] = 1
        known, place = self._places(raw, hashes, starts, ends)
        n = known.size[place]
        at = np.cumsum(n)
        ids = known.ids[np.repeat(known.begin[place] - (at - n), n) + np.arange(int(n.sum()))].astype("<u4", copy=False).tobytes()
        # Words of each text: those that begin before its zero byte.
        stops = np.concatenate(([0], at))[np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]) - 1)].tolist()
        return [ids[4 * a:4 * b] for a, b in zip([0, *stops[:-1]], stops)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@dataclass
class Grammar:
    """A sequence of symbols. Symbols from `first` on are rules: rule k is the pair (left[k], right[k]) of earlier symbols."""

    first: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray       # ids that each rule expands to
    sequence: np.ndarray

    def size_of(self, symbols: np.ndarray) -> np.ndarray:
        rule = symbols >= self.first
        out = np.ones(len(symbols), np.int64)
        out[rule] = self.lengths[symbols[rule] - self.first]
        return out

    def _unrolled(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a few symbols, by replacing rules until none is left."""
        out = symbols
        while (rule := out >= self.first).any():
            n = np.where(rule, 2, 1)
            at = np.cumsum(n) - n
            wide = np.empty(int(n.sum()), np.int64)
            wide[at] = np.where(rule, self.left[np.where(rule, out - self.first, 0)], out)
            wide[at[rule] + 1] = self.right[out[rule] - self.first]
            out = wide
        return out

    def expand(self) -> np.ndarray:
        """The ids of the whole sequence: every rule is unrolled once, then each symbol's ids are copied."""
        if not len(self.left):
            return self.sequence.astype(np.uint32)
        table = np.concatenate((np.arange(self.first), self._unrolled(self.first + np.arange(len(self.left))))).astype(np.uint32)
        begin = np.concatenate((np.arange(self.first), self.first + np.cumsum(self.lengths) - self.lengths))
        n = np.concatenate((np.ones(self.first, np.int64), self.lengths))[self.sequence]
        return table[np.repeat(begin[self.sequence] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi (exclusive) of the shard, decoded from the symbols that cover them alone."""
        ends = np.cumsum(self.size_of(self.sequence))
        a, b = np.searchsorted(ends, lo, side="right"), np.searchsorted(ends, hi)
        before = int(ends[a - 1]) if a else 0
        return self._unrolled(self.sequence[a:b + 1])[lo - before:hi - before].astype(np.uint32)

    def pack(self) -> bytes:
        return pack(np.array([self.first]), self.left, self.right, self.lengths, self.sequence)

    @classmethod
    def unpack(cls, data: bytes) -> Grammar:
        first, left, right, lengths, sequence = unpack(data)
        return cls(int(first[0]), left.astype(np.int64), right.astype(np.int64), lengths.astype(np.int64), sequence.astype(np.int64))


def _frequent_pairs(a: np.ndarray, b: np.ndarray, most: int, least: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to `most` of the most frequent pairs, each with `least` occurrences or more, most frequent first; the places
    where they stand and each such place's pair number.

    Pairs are counted by a hash, another one each turn; of the pairs that share a hash value one is looked
    at, by its exact count, and the others wait for another turn.
    """
    bits = 18
    slot = ((a * np.uint32(2654435761 + 2 * turn) + b * np.uint32(2246822519 - 4 * turn)) >> np.uint32(32 - bits)).astype(np.intp)
    counts = np.bincount(slot, minlength=1 << bits)
    top = np.argpartition(-counts, most)[:most]
    chosen = np.zeros(1 << bits, bool)
    chosen[top[counts[top] >= least]] = True
    at = np.flatnonzero(chosen[slot])
    own, key = slot[at], a[at].astype(np.uint64) << np.uint64(32) | b[at]
    pair = np.zeros(1 << bits, np.uint64)
    pair[own] = key
    same = pair[own] == key
    counts = np.bincount(own[same], minlength=1 << bits)
    order = np.flatnonzero(counts >= least)
    order = order[np.argsort(-counts[order], kind="stable")]
    number = np.full(1 << bits, -1, np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    numbered = number[own]
    numbered[~same] = -1
    kept = numbered >= 0
    return pair[order], at[kept], numbered[kept]


def compress(ids: np.ndarray, pairs_per_round: int = PAIRS_PER_ROUND, max_rounds: int = MAX_ROUNDS,
             min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN) -> Grammar:
    """Re-Pair in rounds: each round replaces the most frequent pairs, the more frequent of two overlapping ones first."""
    sequence = ids.astype(np.uint32)
    first = int(ids.max()) + 1 if len(ids) else 0
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rules = 0
    for turn in range(max_rounds):
        if len(sequence) < 2:
            break
        pairs, at, own = _frequent_pairs(sequence[:-1], sequence[1:], pairs_per_round, min_count, turn)
        if not len(pairs):
            break
        # Take a place whose pair goes before those that overlap it; in a run of one symbol every second place.
        none = np.int32(len(pairs))
        beside = at[1:] == at[:-1] + 1
        before = np.concatenate(([none], np.where(beside, own[:-1], none)))
        behind = np.concatenate((np.where(beside, own[1:], none), [none]))
        take = (own < behind) & (own < before)
        runs = np.flatnonzero((own == behind) | (own == before))
        if len(runs):
            starts = np.flatnonzero(np.concatenate(([True], (at[runs[1:]] != at[runs[:-1]] + 1) | (own[runs[1:]] != own[runs[:-1]]))))
            sizes = np.diff(np.append(starts, len(runs)))
            lo, hi = runs[starts], runs[starts + sizes - 1]
            free = (own[lo] < before[lo]) & (own[lo] < behind[hi])
            take[runs[np.repeat(free, sizes) & ((np.arange(len(runs)) - np.repeat(starts, sizes)) % 2 == 0)]] = True
        at, own = at[take], own[take]
        if not len(at):
            break
        taken = np.bincount(own, minlength=len(pairs)) > 0
        used, number = np.flatnonzero(taken), (np.cumsum(taken) - 1)[own]
        size = len(sequence)
        sequence[at] = (first + rules + number).astype(np.uint32)
        stay = np.ones(size, bool)
        stay[at + 1] = False
        sequence = sequence[stay]
        left.append((pairs[used] >> np.uint64(32)).astype(np.int64))
        right.append((pairs[used] & np.uint64(0xFFFFFFFF)).astype(np.int64))
        rules += len(used)
        if len(at) < min_gain * size:
            break
    lengths = np.zeros(0, np.int64)
    for l, r in zip(left, right):           # rules of a round are made of symbols of earlier rounds
        known = Grammar(first, l, r, lengths, sequence)
        lengths = np.concatenate((lengths, known.size_of(l) + known.size_of(r)))
    return Grammar(first, np.concatenate(left), np.concatenate(right), lengths, sequence)


def _encoded(rows, tokenizer: str):
    """(doc_id, ids as bytes) of rows (doc_id, text), encoded some million characters at a time."""
    encode, ids, texts, size = encoder(tokenizer).encode, [], [], 0
    for doc_id, text in rows:
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= 1_000_000:
            yield from zip(ids, encode(texts))
            ids, texts, size = [], [], 0
    if ids:
        yield from zip(ids, encode(texts))


_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("n_docs", pa.int64()),
                     ("n_ids", pa.int64()), ("docs", pa.binary()), ("grammar", pa.binary())])
_SHARDS_DDL = "part int, shard int, start long, n_docs long, n_ids long, docs binary, grammar binary"


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Encode the texts of `docs` (doc_id, text), append `end_id` to each and write the shards to `path`.

    Documents are in ascending order of doc_id (null first), then of a hash of the text, so repeated
    ids and repeated rows have a place too. A null text counts as empty: its ids are `end_id` alone.
    An empty table writes no shards; other columns are ignored. `start` of a shard counts the ids
    before it in its partition.
    """
    def run(batches):
        part, end = TaskContext.get().partitionId(), int(end_id).to_bytes(4, "little")
        ids, sizes, chunks, n, shard, start = [], [], [], 0, 0, 0

        def row():
            null = np.array([d is None for d in ids], np.uint8)
            keys = np.array([0 if d is None else d for d in ids], np.int64).view(np.uint64)
            known = pack(null, keys, np.array(sizes))
            return batch(_SHARDS, [[part], [shard], [start], [len(ids)], [n], [known],
                                   [compress(np.frombuffer(b"".join(chunks), "<u4")).pack()]])

        for doc_id, own in _encoded(rows_of(batches), tokenizer):
            ids.append(doc_id)
            sizes.append(len(own) // 4 + 1)
            chunks += [own, end]
            n += sizes[-1]
            if n >= shard_ids:
                yield row()
                ids, sizes, chunks, n, shard, start = [], [], [], 0, shard + 1, start + n
        if ids:
            yield row()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (texts_of(docs, "doc_id").repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(run, _SHARDS_DDL).write.option("compression", "none").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The shard table of `path`, each with `base`, the ids of all shards of earlier partitions.

    The sizes of the partitions (one number each) pass through the driver.
    """
    shards = spark.read.schema(_SHARDS_DDL).parquet(path)
    sizes = sorted((r["part"], r["n"]) for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases, total = [], 0
    for part, n in sizes:
        bases.append((part, total))
        total += n
    return shards.join(F.broadcast(spark.createDataFrame(bases, "part int, base long")), "part")


def _documents(doc_part: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Doc ids, whether each is null, and lengths."""
    null, keys, sizes = unpack(doc_part)
    return keys.astype(np.uint64).view(np.int64), null.astype(bool), sizes.astype(np.int64)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document read back; ids as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        for base, start, docs, grammar in rows_of(batches, 1):
            keys, null, sizes = _documents(docs)
            raw = Grammar.unpack(grammar).expand().astype("<u4").tobytes()
            ends = np.cumsum(sizes)
            for lo in range(0, len(keys), 2000):
                own = slice(lo, lo + 2000)
                yield batch(schema, [pa.array(keys[own], mask=null[own]), base + start + ends[own] - sizes[own], sizes[own],
                                     [raw[4 * (e - n):4 * e] for e, n in zip(ends[own].tolist(), sizes[own].tolist())]])

    return (read(spark, path).select("base", "start", "docs", "grammar")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for base, start, docs, grammar in rows_of(batches, 1):
            keys, null, sizes = _documents(docs)
            raw = memoryview(Grammar.unpack(grammar).expand().astype("<u4").tobytes())
            ends = np.cumsum(sizes)
            yield batch(schema, [pa.array(keys, mask=null), base + start + ends - sizes, sizes,
                                 [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]])

    return (read(spark, path).select("base", "start", "docs", "grammar")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def look_up(spark: SparkSession, path: str, doc_ids: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Random access: (doc_id, ids) of the wanted documents, decoding only what covers them in their shards."""
    wanted = np.array(sorted(set(doc_ids)), np.int64)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        for docs, data in rows_of(batches, 1):
            keys, null, sizes = _documents(docs)
            at = np.flatnonzero(np.isin(keys, wanted) & ~null)
            if len(at):
                grammar, ends = Grammar.unpack(data), np.cumsum(sizes)
                yield batch(schema, [keys[at], [grammar.ids(e - n, e).astype("<u4").tobytes() for e, n in zip(ends[at].tolist(), sizes[at].tolist())]])

    found = spark.read.schema(_SHARDS_DDL).parquet(path).select("docs", "grammar").mapInArrow(run, "doc_id long, ids binary")
    for r in found.toLocalIterator():
        yield r["doc_id"], np.frombuffer(r["ids"], "<u4")
