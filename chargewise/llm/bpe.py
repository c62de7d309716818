"""BPE encoding over a table of distinct words, decoding through the id-to-piece table.

1. A task splits its documents into words as the tokenizer's own normaliser and pre-tokeniser do, and
   codes them against the chunk's own word list (a chunk is a bounded run of documents). Per chunk it
   writes the word positions of its documents (compressed codes) and, per bucket of the word hash, the
   chunk's distinct words.
2. The word lists are shuffled by bucket. A task meets every chunk's words of its bucket and encodes
   each distinct word once, with the library; it sends each chunk the ids of its words.
3. Ids and positions meet by chunk: a document's ids are its words' ids in order.

What moves is a chunk's distinct words, not its word occurrences, so a frequent word costs one entry
per chunk. A task holds one chunk, or the distinct words of one bucket (their number follows from the
size of the table), never more.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargewise.llm.common import batch, pack, rows_of, slices_of, texts_of, unpack, written

CHUNK_CHARS = 32_000_000
BUCKET_CHARS = 32_000_000
_DOCS = np.iinfo(np.int32).max       # the bucket number of a chunk's positions: it sorts after the words

_PARTS = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("data", pa.binary())])
_IDS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

# Texts of these characters only are split by the plain pattern below, to the same words: ASCII without
# the separators U+001C to U+001F, and Latin letters that neither normalise nor change length.
_PLAIN = re.compile("[\t-\r -~À-įı-ɏ]*")
_PLAIN_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^\\sa-zß-öø-ɏ0-9]+")


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark runs a task per core
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Splitter:
    """Words of a text, each of which the tokenizer encodes by itself to the ids it has in the text."""

    def __init__(self, path: str):
        from tokenizers import Regex, pre_tokenizers
        with open(path, encoding="utf-8") as fh:
            parts = json.load(fh)
        steps = parts["pre_tokenizer"].get("pretokenizers", [])
        if not steps or steps[0]["type"] != "Split" or not steps[0]["invert"] or steps[0]["behavior"] != "Removed":
            raise ValueError("the tokenizer must split its text into words first")
        self.pattern = steps[0]["pattern"]["Regex"]
        self.normalizer = load(path).normalizer
        self.split = pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        special = [t["content"] for t in parts["added_tokens"]]
        self.special = set(special)
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        lower = [n["type"] for n in parts["normalizer"].get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.plain = lower and self.pattern == "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

    def words(self, text: str) -> list[str]:
        if self.parts is not None and any(s in text for s in self.special):
            return [w for part in self.parts.split(text) for w in ([part] if part in self.special else self._words(part))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if self.plain and _PLAIN.fullmatch(text):
            return _PLAIN_WORD.findall(text.lower())
        return [w for w, _ in self.split.pre_tokenize_str(self.normalizer.normalize_str(text))]


@lru_cache(maxsize=4)
def _splitter(path: str) -> Splitter:
    return Splitter(path)


class _Chunk:
    """The documents of a chunk as codes of its own words."""

    def __init__(self):
        self.codes: defaultdict[str, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__
        self.doc_ids: list = []
        self.docs: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id, text: str, words: list[str]) -> None:
        self.doc_ids.append(doc_id)
        self.docs.append(np.fromiter(map(self.codes.__getitem__, words), np.uint32, len(words)))
        self.chars += len(text)

    def rows(self, buckets: int) -> pa.RecordBatch:
        words = list(self.codes)
        self.codes.clear()                 # the largest part of a chunk's memory
        all_codes = np.concatenate(self.docs)
        by_count = np.argsort(-np.bincount(all_codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[by_count] = np.arange(len(words), dtype=np.uint32)
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        own = np.array([xxhash.xxh64_intdigest(w) % buckets for w in raw], np.int64)
        order = np.array(sorted(range(len(words)), key=raw.__getitem__), np.int64)
        order = order[np.argsort(own[order], kind="stable")]                   # by bucket, then by word
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        cuts = np.searchsorted(own[order], np.arange(buckets + 1)) if words else np.zeros(buckets + 1, int)
        chunk = uuid.uuid4().hex
        lists = [(b, zstandard.compress(b"\n".join(raw[i] for i in order[cuts[b]:cuts[b + 1]].tolist()), 3))
                 for b in range(buckets) if cuts[b] < cuts[b + 1]]
        ids = np.array([0 if d is None else d for d in self.doc_ids], np.int64).view(np.uint64)
        null = np.array([d is None for d in self.doc_ids], np.uint8)
        data = pack(ids, null, np.array([len(d) for d in self.docs]), place[by_count], rank[all_codes])
        return batch(_PARTS, [[chunk] * (len(lists) + 1), [b for b, _ in lists] + [_DOCS], [w for _, w in lists] + [data]])


def encode(docs: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS, buckets: int | None = None,
           decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) for every row of `docs` (doc_id, text): ids as little-endian unsigned
    32-bit integers, as the library gives them without added special tokens, truncation and padding.

    A null text counts as empty: no ids. Null doc_ids and repeated rows keep their own result rows;
    an empty table gives an empty result; other columns are ignored. `path`: the tokenizer's file,
    at the same place on all machines. `buckets`: parts of the word table, by default from its size.
    `decoded`: also decode the ids where they are placed and add the column text, as `decode` does.
    """
    docs = texts_of(docs, "doc_id")
    if buckets is None:
        size = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
        buckets = max(16, size // BUCKET_CHARS)

    def split(batches):
        splitter, chunk = _splitter(path), _Chunk()
        for doc_id, text in rows_of(batches):
            chunk.add(doc_id, text, splitter.words(text))
            if chunk.chars >= chunk_chars:
                yield chunk.rows(buckets)
                chunk = _Chunk()
        if chunk.docs:
            yield chunk.rows(buckets)

    def encode_words(batches):
        tokenizer, bucket, known = load(path), None, {}
        for chunk, own, data in rows_of(batches, 8):
            if own != bucket:
                bucket, known = own, {}
            words = zstandard.decompress(data).split(b"\n")
            new = [w for w in words if w not in known]
            for lo in range(0, len(new), 10_000):
                part = new[lo:lo + 10_000]
                for w, e in zip(part, tokenizer.encode_batch([w.decode("utf-8", "surrogatepass") for w in part], add_special_tokens=False)):
                    known[w] = np.array(e.ids, "<u4").tobytes()
            ids = [known[w] for w in words]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            yield batch(_PARTS, [[chunk], [own], [pack(sizes, np.frombuffer(b"".join(ids), "<u4"))]])

    def place_ids(batches):
        chunk, sizes, ids = None, [], []
        text_of = _decoder(path) if decoded else None
        for own, bucket, data in rows_of(batches, 8):
            if own != chunk:
                chunk, sizes, ids = own, [], []
            if bucket != _DOCS:
                n, values = unpack(data)
                sizes.append(n.astype(np.uint16 if not len(n) or n.max() < 1 << 16 else np.int64))
                ids.append(values.astype("<u4"))
            else:
                yield from _documents(data, sizes, ids, text_of)

    parts = written(docs.mapInArrow(split, "chunk string, bucket int, data binary"), "bpe-parts", compression="none")
    lists = parts.where(F.col("bucket") != _DOCS)
    coded = (lists.repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(encode_words, "chunk string, bucket int, data binary"))
    return (coded.unionByName(parts.where(F.col("bucket") == _DOCS))
            .repartition("chunk").sortWithinPartitions("chunk", "bucket")
            .mapInArrow(place_ids, "doc_id long, n_tokens long, ids binary" + ", text string" * decoded))


def _documents(data: bytes, sizes: list[np.ndarray], ids: list[np.ndarray], text_of=None):
    """The ids of a chunk's documents, from its positions and its words' ids; also as text if `text_of` is given."""
    doc_ids, null, lengths, place, codes = unpack(data)
    size = np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)
    flat = np.concatenate([*ids, np.zeros(0, "<u4")])
    if len(size) != len(place):
        raise ValueError("a chunk's word lists are incomplete")
    first = np.cumsum(size) - size
    size, first = size[place], first[place]
    doc_ids, lengths = doc_ids.astype(np.uint64).view(np.int64), lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(lengths):                       # documents of about 200,000 words at a time, one at least
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + 200_000)))
        own = codes[ends[lo] - lengths[lo]:ends[hi - 1]]
        n = size[own]
        stop = np.cumsum(n)
        out = flat[np.repeat(first[own] - (stop - n), n) + np.arange(int(n.sum()))]
        stops = np.concatenate(([0], stop))[ends[lo:hi] - (ends[lo] - lengths[lo])]
        starts = np.concatenate(([0], stops[:-1]))
        raw = out.tobytes()
        columns = [pa.array(doc_ids[lo:hi], mask=null[lo:hi].astype(bool)), stops - starts,
                   [raw[4 * s:4 * e] for s, e in zip(starts.tolist(), stops.tolist())]]
        if text_of is None:
            yield batch(_IDS, columns)
        else:
            yield batch(_IDS.append(pa.field("text", pa.string())), [*columns, list(map(text_of, columns[2]))])
        lo = hi


def _decoder(path: str):
    """From ids as bytes to the library's decoded text, special tokens kept, through the id-to-piece table."""
    tokenizer = load(path)
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    pieces: list = [None] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = piece
    join = " ".join if tokenizer.decoder is None else tokenizer.decoder.decode
    return lambda raw: None if raw is None else join([pieces[i] for i in np.frombuffer(raw, "<u4").tolist()])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` (with ids, as `encode` returns them) with the decoded text added, special tokens kept.

    Each id is looked up in the tokenizer's id-to-piece table (its size is the vocabulary's, so every
    task holds it). Without a decoder the library joins the pieces by spaces; with one it is applied.
    Null ids give a null text, no ids the empty text. A column named text is replaced.
    """
    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        decoder = _decoder(path)
        return pa.array([decoder(raw) for own in slices_of(column) for raw in own], pa.string())

    return encoded.withColumn("text", text_of("ids"))
