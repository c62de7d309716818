import re

import numpy as np
import xxhash

from chargewise.llm import simhash as S
from tests.llm.conftest import AWKWARD


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_groups(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(prints))]


def expected(rows, bits=3):
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = slow_groups(prints, bits)
    least = {}
    for (doc_id, _), r in zip(rows, roots):
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    return sorted(((d, format(p, "016x"), least[r]) for (d, _), p, r in zip(rows, prints, roots)), key=str)


def test_fingerprint_of_short_and_odd_texts():
    for text in ("", " \n", "one", "one two", "One TWO three", "a b c d", "É É é", "x\x1cy z\x85 w", "a " * 70_000):
        assert S.fingerprint(text) == slow_fingerprint(text)


def test_groups_of_awkward_rows(awkward, empty):
    got = sorted((tuple(r)[:3] for r in S.near_duplicates(awkward).collect()), key=str)
    assert got == expected([r[:2] for r in AWKWARD])
    assert S.near_duplicates(empty).collect() == []


def test_links_by_any_cut_of_shards_and_trees(spark, rng):
    centres = [rng.getrandbits(64) for _ in range(6)]
    points = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(40)}
    points = sorted(points)
    roots = slow_groups(points, 3)
    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "fp long")
    for options in ({}, {"tree_size": 4}, {"blocks": 6, "tree_size": 16}):
        at = {p: i for i, p in enumerate(points)}
        up = list(range(len(points)))

        def find(i):
            while up[i] != i:
                i = up[i]
            return i

        links = S.links(table, **options).collect()
        for r in links:
            a, b = (int(np.int64(x).view(np.uint64)) for x in r)
            assert (a ^ b).bit_count() <= 3
            p, q = find(at[a]), find(at[b])
            up[max(p, q)] = min(p, q)
        assert [find(i) for i in range(len(points))] == roots


def test_tree_follows_edges_within_the_radius(rng):
    tree, points = S.BKTree(), [rng.getrandbits(16) for _ in range(500)]
    for p in points:
        tree.add(p)
    for q in points[:50]:
        assert sorted(tree.within(q, 2)) == sorted({p for p in points if (p ^ q).bit_count() <= 2})


def test_one_of_each_keeps_the_smallest_id(awkward, empty):
    kept = S.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len(set(slow_groups([slow_fingerprint(r[1]) for r in AWKWARD], 3)))
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert (5, AWKWARD[5][1]) in texts and (6, AWKWARD[8][1]) in texts and (6, AWKWARD[5][1]) not in texts
    assert len([t for t in texts if t[1] in (None, "", " \n\t ")]) == 1        # no words: one group
    assert S.one_of_each(empty).collect() == []
