import numpy as np
import pytest

from chargewise.llm import ann


def slow(rows, k=5, every=50):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v
                   and np.isfinite(v).all() and any(v) and len(v) == len(rows[0][1])})
    x = np.array([v for _, v in good], np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for at, (i, _) in enumerate(good):
        if i % every == 0:
            near = x @ x[at]
            best = sorted((-round(float(s), 12), j) for s, (j, _) in zip(near, good) if j != i)
            out[i] = [(j, pytest.approx(-s, abs=1e-9)) for s, j in best[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_small_tables_are_exact(spark, rng):
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(200)]
    vectors += [(1000 + i, [1.0] + [0.5] * 7) for i in range(60)]             # copies: ties go to the smaller id
    odd = [(None, [1.0] * 8), (300, None), (350, [0.0] * 8), (400, [float("nan")] * 8), (450, [None] + [1.0] * 7), (500, [1.0]), (0, vectors[0][1])]
    rows = vectors + odd
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    single = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    got = found(ann.nearest(df.withColumnRenamed("embedding", "embedding")))
    want = slow(single)
    assert got.keys() == want.keys()
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]]
        assert [s for _, s in got[q]] == [s for _, s in want[q]]


def test_few_or_no_vectors(spark):
    two = spark.createDataFrame([(0, [1.0, 0.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert found(ann.nearest(two)) == {0: [(3, pytest.approx(0.5 ** 0.5))]}
    assert ann.nearest(two.limit(0)).collect() == []
    assert ann.nearest(two.where("vec_id = 0")).collect() == []


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(1 << bits * dims))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def recall(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    want, got = slow(rows), found(ann.nearest(df))                      # default parameters
    assert want.keys() == got.keys()
    share = {q: len({j for j, _ in want[q]} & {j for j, _ in got[q]}) / len(want[q]) for q in want}
    return share, want, got


@pytest.mark.parametrize("noise", [0.01, 0.003, 0.0003])
def test_recall_in_a_group_of_near_copies(spark, noise):
    """A third of the rows are one vector and some noise: finer than codes, larger than windows."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4500, 64))
    x[::3] = x[0] + noise * np.linalg.norm(x[0]) / 8 * rng.normal(size=(1500, 64))
    share, _, _ = recall(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    assert np.mean([s for q, s in share.items() if q % 3 == 0]) >= 0.99 and np.mean(list(share.values())) >= 0.9


def test_scaled_copies_are_ties(spark):
    """Parallel vectors have one direction: of equal scores the smaller ids count."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 32))
    x[::3] = x[0] * rng.uniform(0.1, 9, size=(1000, 1))
    share, want, got = recall(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    assert all(s == 1 for q, s in share.items() if q % 3 == 0)
    assert [j for j, _ in got[300]] == [j for j, _ in want[300]] == [0, 3, 6, 9, 12]


def test_recall_on_the_test_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want, got = slow(rows), found(ann.nearest(table))
    hits = sum(len({j for j, _ in want[q]} & {j for j, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
