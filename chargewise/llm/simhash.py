"""SimHash near-duplicates: fingerprints linked within a few bits by sharded BK-trees.

1. One pass over the texts gives each document's 64-bit fingerprint (numpy inside Arrow batches).
2. Equal fingerprints are folded, so exact copies cost one node however many there are.
3. Two fingerprints within `max_bits` differ in at most `max_bits` of `blocks` bit blocks, so they
   agree on `blocks - max_bits` of them. Each choice of that many blocks and their value names a
   shard; every pair that can link meets in a shard. More blocks give finer shards (and more of
   them): 4 suits up to about 10^9 distinct fingerprints, 5 or 6 more. All are exact.
4. A shard larger than `tree_size` is cut into several trees by a hash of the fingerprint. Each tree
   travels to every piece of its shard's queries (a copy per piece, through the shuffle: broadcasting
   trees from the driver would collect all fingerprints there), so no task holds over 2 x `tree_size`
   fingerprints, whatever the skew.
5. A task builds a BK-tree (children keyed by their integer Hamming distance to the parent), walks
   only edges within the radius and reports a spanning forest of the links, never all pairs.
6. Connected components give the groups.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargewise.llm.common import batch, slices_of, sorted_groups, texts_of, whole_rows, written
from chargewise.llm.components import connected_components

MAX_BITS = 3
SHINGLE_WORDS = 3
SEED = 42

_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of a text; 0 for a text without words.

    Words are runs without ASCII white space, A-Z lower-cased (`bytes.lower` and `bytes.split` do
    exactly that); shingles are `words` words joined by a space, repeats included.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    flat = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) > words:
        starts, ends = starts[:len(tokens) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for lo in range(0, len(starts), 1 << 16):    # a very long text in pieces
        hashes = np.array([digest(flat[s:e], SEED) for s, e in
                           zip(starts[lo:lo + (1 << 16)].tolist(), ends[lo:lo + (1 << 16)].tolist())], "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Null texts count as empty."""
    def run(batches):
        for b in batches:
            values = [fingerprint(t, words) for own in slices_of(b.column(1)) for t in own]
            yield batch(_FP, [b.column(0).cast(pa.int64()), np.array(values, np.uint64).view(np.int64)])
    return texts_of(docs, "doc_id").mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """A metric tree over integers: the child of a node under key k is at Hamming distance k from it."""

    def __init__(self):
        self.keys: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        new = len(self.keys)
        at = 0
        while new:
            d = (self.keys[at] ^ x).bit_count()
            if d == 0:
                return
            child = self.edges[at].get(d)
            if child is None:
                self.edges[at][d] = new
                break
            at = child
        self.keys.append(x)
        self.edges.append({})

    def within(self, x: int, radius: int) -> list[int]:
        """The stored integers within `radius` bits of x."""
        found, todo = [], [0] if self.keys else []
        while todo:
            at = todo.pop()
            d = (self.keys[at] ^ x).bit_count()
            if d <= radius:
                found.append(self.keys[at])
            edges = self.edges[at]
            if len(edges) > 2 * radius + 1:
                todo.extend(edges[k] for k in range(d - radius, d + radius + 1) if k in edges)
            else:
                todo.extend(v for k, v in edges.items() if abs(k - d) <= radius)
        return found


def _forest(members: list[int], queries: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest: within `members`, or between `queries` and `members`."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    tree, links = BKTree(), []

    def link(x: int) -> None:
        for y in tree.within(x, radius):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                links.append((x, y))

    if queries is None:
        for x in members:
            link(x)
            tree.add(x)
    else:
        for x in members:
            tree.add(x)
        for x in queries:
            link(x)
    return links


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None, tree_size: int = 4096) -> DataFrame:
    """(a, b): a spanning set of the links between distinct fingerprints (column fp) at `max_bits` or fewer bits."""
    blocks = blocks or max_bits + 1
    if not max_bits < blocks <= 64:
        raise ValueError("blocks must be over max_bits and at most 64")
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum((1 << b) - 1 - ((1 << a) - 1) for a, b in (cuts[i:i + 2] for i in chosen))
             for chosen in combinations(range(blocks), blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    shards = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("value"))
        for i, m in enumerate(signed)])).alias("s")).select("s.block", "s.value", "fp")
    hot = (shards.groupBy("block", "value").count().where(F.col("count") > tree_size)
           .select("block", "value", F.ceil(F.col("count") * 2 / tree_size).cast("int").alias("pieces")))
    cut = shards.join(hot, ["block", "value"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", "block"), F.col("pieces")).cast("int")
    units = (cut.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
             .select("block", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") >= F.col("other")).cast("int").alias("tree"), "fp"))

    def run(batches):
        a: list[int] = []
        b: list[int] = []
        for group in sorted_groups(batches, 4):
            if len(group[5]) > 1:
                same = group[2][0] == group[3][0]
                values, in_tree = group[5].view(np.uint64), group[4] == 1
                found = (_forest(values.tolist(), None, max_bits) if same else
                         _forest(values[in_tree].tolist(), values[~in_tree].tolist(), max_bits))
                for x, y in found:
                    a.append(x)
                    b.append(y)
            if len(a) > 100_000:
                yield batch(_EDGE, [np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)])
                a, b = [], []
        yield batch(_EDGE, [np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)])

    return (units.repartition("block", "value", "i", "j").sortWithinPartitions("block", "value", "i", "j", "fp")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, words: int = SHINGLE_WORDS,
                    blocks: int | None = None, tree_size: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id, root) for every row of `docs` (doc_id, text).

    A null text has no words: fingerprint zero, linked like any other. Repeated rows each get a
    result row. `component_id` is the smallest non-null doc_id of the group (null if it has none);
    `root` is the group's least fingerprint as a signed long. An empty table gives an empty result; other columns are ignored.
    """
    fps = written(fingerprints(docs, words), "simhash")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    members = connected_components(links(nodes.select("fp"), max_bits, blocks, tree_size))
    rooted = nodes.join(members.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = rooted.join(firsts, "root").select("fp", "component_id", "root")
    return fps.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS, words: int = SHINGLE_WORDS) -> DataFrame:
    """The row of `docs` (any columns) with the smallest doc_id of each group (null last, then by fingerprint).

    Rows that share doc_id and group count as one document: one of them stays.
    """
    groups = written(near_duplicates(docs, max_bits, words), "simhash-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")
    first = (groups.groupBy("root").agg(F.min(order).alias("least"))
             .select("root", F.col("least.doc_id").alias("_id"), F.col("least.fingerprint").alias("_fp")))
    shared = groups.groupBy("doc_id").agg(F.count_distinct("fingerprint").alias("n")).where("n > 1 or doc_id is null")
    first = first.join(shared.select(F.col("doc_id").alias("_shared")), F.col("_id").eqNullSafe(F.col("_shared")), "left") \
        .withColumn("_many", F.col("_id").isNull() | F.col("_shared").isNotNull())

    @F.arrow_udf("string")
    def print_of(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else format(fingerprint(t, words), "016x") for own in slices_of(texts) for t in own], pa.string())

    # The text decides only where several documents share the id; elsewhere no fingerprint is computed again.
    rows = whole_rows(docs, "doc_id", "text")
    joined = rows.join(first, rows["doc_id"].eqNullSafe(first["_id"]))
    text = F.when(F.col("_many"), F.coalesce(F.col("text"), F.lit("")))
    return (joined.withColumn("_own", print_of(text)).where("_own is null or _own = _fp")
            .dropDuplicates(["root"]).select("row.*"))
