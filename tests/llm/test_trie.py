import hashlib
import random
import zlib

import pytest

from chargewise.llm import trie
from chargewise.llm.common import read_table
from tests.llm.conftest import SF


def slow(rows):
    """{path: node} by plain sets; rows of (conv_id, turn, role, text) without ties."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1] or 0)):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [v for v in members if v[:len(node)] == node]
        children = {v for v in below if len(v) == len(node) + 1}
        leaves = sum(1 for v in below if not any(w != v and w[:len(v)] == v for w in below))
        saved = sum((len(members[v]) - 1) * len(v[-1][1]) for v in below if v)
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def fast(df):
    return sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=repr)


DDL = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_sets(spark, monkeypatch, seed):
    monkeypatch.setattr(trie, "SHARD_IDS", 200)         # several shards, so nodes meet across them
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 1500), 220):
        turns = [(rng.choice(["user", "tool"]), rng.choice("ab")) for _ in range(rng.randrange(7))]
        if rng.random() < 0.3:
            turns = [("user", "the same"), ("tool", "beginning")] + turns
        rows += [(c, t if t else None, role, text) for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    assert fast(spark.createDataFrame(rows, DDL).repartition(5)) == slow(rows)


def test_equals_plain_sets_on_the_test_table(spark):
    table = read_table(spark, SF, "conversations")
    assert fast(table) == slow([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "of no conversation"), (200, None, None, None), (200, 1, "user", ""), (200, 1, "user", ""),
            (7, 3, "user", "long " * 50_000), (100, 0, "é", "字😀"), (-1, 0, "user", "below zero")]
    df = spark.createDataFrame([(*r, b"k", 1, 2.0) for r in rows], DDL + ", key binary, depth long, parent double")
    got = fast(df)
    repeated = [r for r in got if r[0] == 200]          # the repeated row is a turn of its own
    assert max(r[1] for r in repeated) == 3
    assert [r[3] for r in got if r[1] == 0] == [4]      # 200, 7, 100 and -1 below one root
    assert got == slow(rows)
    assert fast(df.limit(0)) == []


def test_one_turn_in_every_conversation(spark):
    """A first turn that all share: one row per shard reaches the merge, not one per conversation."""
    rows = [(c, 0, "user", "hello") for c in range(3000)] + [(c, 1, "user", str(c % 7)) for c in range(0, 3000, 2)]
    assert fast(spark.createDataFrame(rows, DDL)) == slow(rows)
