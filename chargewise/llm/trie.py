"""The prefix trie of conversations, by vertical bitmaps.

1. Turns are hashed where they are read (128 bits of role and text), so no text is shuffled. Conversations
   are dealt into shards by ranges of SHARD_IDS conversation ids, which also hold the conversations that
   others are rebuilt from.
2. A shard keeps, for each (position, turn) that several conversations share, the bitset of these
   conversations. From the root down, the members of a node (a bitset) are intersected with the postings
   of the next position: each non-empty intersection is a child, its popcount the number of its members,
   and the members that end there are the node's end list. A path of one conversation needs no bitsets.
3. Nodes of different shards are the same if their prefixes are: a node's key is a chained 128-bit hash of its turns.
   A shard sends one row per node, whatever the number of members, so hot prefixes are folded before they meet.
4. Sums over subtrees need distinct nodes. Each node is owned by its smallest member, and a conversation that
   owns a node owns all deeper nodes of its path; so two numbers per conversation (the depth from which it owns
   its path, and whether the path ends in a leaf) let the shards walk their bitsets again and add up
   subtree sums that are additive over shards. No node is sent to its ancestors.
5. End lists are hashed as a stream of shards in ascending order of ids.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargewise.llm.common import batch, bounded, ints, key_runs, rows_of, sorted_groups, written

SHARD_IDS = 1000
GROUP = 100                 # conversations of a group are rebuilt from its first
MAX_TURNS = 6
ROOT = bytes(16)


def _bits(members: int):
    """Places of the set bits, ascending."""
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


class Shard:
    """Conversations `ids` (ascending), each a list of places in `turns` (16-byte digests) and `chars`."""

    def __init__(self, ids: list[int], paths: list[list[int]], turns: list[bytes], chars: list[int]):
        self.ids, self.paths, self.turns, self.chars = ids, paths, turns, chars
        self.ends_at: dict[int, int] = {}
        seen: dict[tuple[int, bytes], int] = {}
        self.postings: dict[tuple[int, bytes], int] = {}
        for i, path in enumerate(paths):
            self.ends_at[len(path)] = self.ends_at.get(len(path), 0) | 1 << i
            for at, row in enumerate(path):
                where = (at, turns[row])
                first = seen.setdefault(where, i)
                if first != i:
                    self.postings[where] = self.postings.get(where, 1 << first) | 1 << i

    def nodes(self):
        """(key, parent's key, depth, members) of every node, the root first."""
        stack = [(ROOT, None, 0, (1 << len(self.ids)) - 1)]
        while stack:
            key, parent, depth, members = stack.pop()
            yield key, parent, depth, members
            rest = members & ~self.ends_at.get(depth, 0)
            while rest:
                i = (rest & -rest).bit_length() - 1
                path = self.paths[i]
                child = members & self.postings.get((depth, self.turns[path[depth]]), 1 << i)
                rest &= ~child
                if child & (child - 1):
                    stack.append((self._key(key, path[depth]), key, depth + 1, child))
                    continue
                above = key
                for at in range(depth, len(path)):          # one conversation is left: its path, turn by turn
                    own = self._key(above, path[at])
                    yield own, above, at + 1, child
                    above = own

    def _key(self, parent: bytes, row: int) -> bytes:
        return xxhash.xxh3_128_digest(parent + self.turns[row])


def rebuilt(conv_id: int) -> tuple[int, int]:
    """The conversation from which `conv_id` takes its first turns, and how many."""
    return conv_id - conv_id % GROUP, zlib.crc32(str(conv_id).encode()) % MAX_TURNS


def _shard(conv: np.ndarray, d1: np.ndarray, d2: np.ndarray, chars: np.ndarray) -> Shard:
    """The shard of rows in order of conversation and turn, with its conversations rebuilt."""
    raw = np.ascontiguousarray(np.stack((d1, d2), axis=1)).tobytes()
    turns = [raw[16 * i:16 * i + 16] for i in range(len(conv))]
    cuts = key_runs([conv])
    span = dict(zip(conv[cuts[:-1]].tolist(), zip(cuts[:-1].tolist(), cuts[1:].tolist())))
    paths = []
    for own, (lo, hi) in span.items():
        base, h = rebuilt(own)
        a, b = span.get(base, (0, 0))
        paths.append([*range(a, min(a + h, b)), *range(min(lo + h, hi), hi)])
    return Shard(list(span), paths, turns, chars.tolist())


_PART = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                   ("n", pa.int64()), ("shard", pa.int64()), ("ends", pa.binary())])
_PART_DDL = "key binary, parent binary, depth long, conv_id long, n long, shard long, ends binary"


def _in_batches(rows, schema: pa.Schema, size: int = 5000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch(schema, list(zip(*held)))
            held = []
    if held:
        yield batch(schema, list(zip(*held)))


def _count(batches):
    """Nodes of each shard."""
    def rows():
        for shard, conv, d1, d2, chars in sorted_groups(batches, 1):
            s = _shard(conv, d1, d2, chars)
            for key, parent, depth, members in s.nodes():
                ends = members & s.ends_at.get(depth, 0)
                yield (key, parent, depth, s.ids[(members & -members).bit_length() - 1], members.bit_count(), int(shard[0]),
                       np.array([s.ids[i] for i in _bits(ends)], "<i8").tobytes() if ends else None)

    yield from _in_batches(rows(), _PART)


_SUMS = pa.schema([("key", pa.binary()), ("n_leaves", pa.int64()), ("saved", pa.int64())])


def _add_up(batches):
    """Each shard's share of the subtree sums of its nodes. The rows of a shard are its conversations' owned
    depths (kind 0: from, leaf), then its turns (kind 1)."""
    def rows():
        for _, kind, conv, d1, d2, chars in sorted_groups(batches, 1):
            marks, own = kind == 0, kind == 1
            owned = dict(zip(conv[marks].tolist(), zip(d1[marks].tolist(), d2[marks].tolist())))
            s = _shard(conv[own], d1[own], d2[own], chars[own])
            leaf, again = [], []        # again[i][d]: characters of the turns from depth d on that i doesn't own, first at depth 1
            for i, path in enumerate(s.paths):
                start, is_leaf = owned.get(s.ids[i], (len(path) + 1, 0))
                leaf.append(is_leaf)
                tail = np.array([s.chars[r] if at + 1 < start else 0 for at, r in enumerate(path)], np.int64)
                again.append(np.append(np.cumsum(tail[::-1])[::-1], 0).tolist())
            for key, _, depth, members in s.nodes():
                at = max(depth - 1, 0)
                yield key, sum(leaf[i] for i in _bits(members)), sum(again[i][at] for i in _bits(members))

    yield from _in_batches(rows(), _SUMS)


def _hash_ends(batches):
    """SHA-256 of each node's end list, from rows in order of (key, shard)."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def rows():
        key, digest = None, None
        for own, ends in rows_of(batches, 64):
            listed = ",".join(map(str, np.frombuffer(ends, "<i8").tolist())).encode()
            if own != key:
                if key is not None:
                    yield key, digest.hexdigest()
                key, digest = own, hashlib.sha256(listed)
            else:
                digest.update(b"," + listed)
        if key is not None:
            yield key, digest.hexdigest()

    yield from _in_batches(rows(), schema)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Input: (conv_id, turn, role, text), one row per turn. A conversation's turns are ordered by turn, null first; rows that
    share conversation and turn follow in order of a hash of role and text, repeated rows are turns of their own. A null role
    or text counts as empty, a row without conv_id belongs to no conversation. Every conversation is rebuilt (`rebuilt`): its
    first turns are those of the first conversation of its group of 100 ids (groups begin at multiples of 100, also
    below zero). No conversation, no node; other columns are ignored. Long texts travel as hashes, a long conversation has its turns'
    hashes in one shard.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    turns = (bounded(conversations).where(conv.isNotNull())
             .select(F.floor(conv / SHARD_IDS).cast("long").alias("shard"), conv.alias("conv_id"), F.col("turn").alias("turn"),
                     F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit("second"), role, text).alias("d2"),
                     F.length(text).cast("long").alias("chars")))
    in_order = ["shard", "conv_id", F.col("turn").asc_nulls_first(), "d1", "d2"]
    parts = written(turns.repartition("shard").sortWithinPartitions(*in_order).select("shard", "conv_id", "d1", "d2", "chars")
                    .mapInArrow(_count, _PART_DDL), "trie-parts")
    nodes = written(parts.groupBy("key", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs")),
                    "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "trie-nodes")

    no = F.lit(None)
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("d1"), F.max((F.col("n_children") == 0).cast("long")).alias("d2"))
    both = owned.select(F.floor(F.col("conv_id") / SHARD_IDS).cast("long").alias("shard"), F.lit(0).alias("kind"), "conv_id",
                        no.cast(turns.schema["turn"].dataType).alias("turn"), "d1", "d2", F.lit(0).cast("long").alias("chars")) \
        .unionByName(turns.withColumn("kind", F.lit(1)))
    sums = (both.repartition("shard").sortWithinPartitions(in_order[0], "kind", *in_order[1:])
            .select("shard", "kind", "conv_id", "d1", "d2", "chars")
            .mapInArrow(_add_up, "key binary, n_leaves long, saved long")
            .groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    ends = (parts.where("ends is not null").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
            .select("key", "ends").mapInArrow(_hash_ends, "key binary, ends_sha256 string"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(sums, "key").join(ends, "key", "left").join(above, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
