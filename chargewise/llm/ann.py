"""Approximate nearest neighbours (cosine) along shifted Hilbert curves.

1. Equal vectors are folded into one class with its smallest ids, so however often a vector repeats it
   takes one place on a curve. Only the smallest ids can be among the nearest (ties go to them).
2. Each of `curves` orderings projects the vectors by its own random rotation to a few dimensions,
   turns each into quantiles (fitted on a bounded sample), shifts the grid and gives every class a
   Hilbert key. Spark range-partitions and sorts (curve, key); ranks follow from partition sizes.
3. On each curve a query meets all classes within `window` ranks of its own. Curves are cut into pieces
   of PIECE ranks; a query goes to the pieces that its window covers. Pieces are by rank, so no task
   depends on how keys are spread. Here vectors travel as 8-bit codes, each with its distance from the
   vector, so a code's cosine gives bounds of the true one. Each piece reports each query's best few and the
   upper bound of the rest.
4. The neighbouring windows of all curves are merged. Every class whose upper bound reaches the k-th best lower bound is
   scored by the original vectors in double precision.
5. Where that may be more than `rerank` classes, or ones that a piece didn't report, the codes can't decide: the
   query lies in a group of near copies, larger than windows and finer than codes. Such queries are compared with
   all classes in double precision, block by block.

`window` is `share` of the classes (256 at least). On vectors without any structure (as in the test
tables: neighbours at cosine 0.45 among independent directions in 64 dimensions) no ordering keeps
neighbours within a fixed number of ranks, so recall needs a share; clustered vectors need far less.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargewise.llm.common import batch, ints, sorted_groups, written

CURVES = 24
SHARE = 0.02
DIMS, BITS = 20, 3
SAMPLE = 5000
PIECE = 2048
PER_PIECE = 16
RERANK = 48
BLOCK = 16_384              # classes, and queries, of a block of the exact search
DIGITS = 12                 # scores that agree in so many decimals are ties


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve (unsigned 64-bit) of points given by their cell (0 to 2^bits - 1) in each dimension."""
    x = cells.astype(np.uint32)
    n, dims = x.shape
    for b in range(bits - 1, 0, -1):                    # undo the rotations of each level
        bit, low = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for i in range(dims):
            set_ = (x[:, i] & bit) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & low).astype(np.uint32)
            x[:, 0] ^= np.where(set_, low, swap).astype(np.uint32)
            x[:, i] ^= swap
    for i in range(1, dims):                            # Gray code across dimensions
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.uint32)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] & np.uint32(1 << b), np.uint32((1 << b) - 1), np.uint32(0))
    x ^= flip[:, None]
    key = np.zeros(n, np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << np.uint64(1) | (x[:, i] >> np.uint32(b) & np.uint32(1)).astype(np.uint64)
    return key


@dataclass
class Curves:
    """Rotations, quantiles (of a sample) and shifts of the orderings."""

    rotations: list[np.ndarray]
    quantiles: list[np.ndarray]
    shifts: list[np.ndarray]
    bits: int

    @classmethod
    def fit(cls, sample: np.ndarray, size: int, curves: int, seed: int = 7) -> Curves:
        rng = np.random.default_rng(seed)
        dims = min(DIMS, size)
        bits = min(BITS if dims == DIMS else 60 // dims, 10)
        rotations = [np.linalg.qr(rng.normal(size=(size, size)))[0][:, :dims] for _ in range(curves)]
        grid = (np.arange(256) + 0.5) / 256
        return cls(rotations, [np.quantile(sample @ r, grid, axis=0) for r in rotations],
                   [rng.random(dims) for _ in range(curves)], bits)

    def keys(self, unit: np.ndarray) -> list[np.ndarray]:
        """Per curve the Hilbert keys of unit vectors, as signed longs in the same order."""
        cells = 1 << self.bits
        out = []
        for rotation, quantiles, shift in zip(self.rotations, self.quantiles, self.shifts):
            flat = unit @ rotation
            place = np.stack([np.searchsorted(quantiles[:, i], flat[:, i]) for i in range(flat.shape[1])], axis=1) / 256
            grid = np.minimum((place * (cells - 1) + shift).astype(np.int64), cells - 1)
            out.append((hilbert_keys(grid, self.bits) >> np.uint64(1)).astype(np.int64))
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)        # else squares of extreme values leave the range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codes(unit: np.ndarray) -> np.ndarray:
    return np.rint(unit / np.abs(unit).max(axis=1, keepdims=True) * 127).astype(np.int8)


def _with_error(unit: np.ndarray) -> list[bytes]:
    """Each vector's code, followed by the distance between the directions of vector and code (32-bit, rounded up)."""
    code = _codes(unit)
    near = code / np.linalg.norm(code.astype(np.float64), axis=1, keepdims=True)
    off = (np.linalg.norm(unit - near, axis=1) * 1.001 + 2e-6).astype("<f4")
    return [c.tobytes() + e.tobytes() for c, e in zip(code, off)]


def _matrix(column: list[bytes], dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype).reshape(len(column), -1)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, vector as little-endian doubles) of the rows that take part, and the dimension."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull())
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes is not None else 0
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary())])

    def run(batches):
        for b in batches:
            ids, lists = ints(b.column(0)), b.column(1)
            x = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(len(ids), size)    # null: nan
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            x = x + 0.0                                   # -0.0 and 0.0 are the same component
            raw = x.tobytes()
            yield batch(schema, [ids[good], [raw[8 * size * i:8 * size * (i + 1)] for i in np.flatnonzero(good).tolist()]])

    return rows.where(F.size("v") == size).mapInArrow(run, "vec_id long, vector binary"), size


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
            curves: int = CURVES, share: float = SHARE, rerank: int = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row whose id is divisible by `every`.

    Nearest by cosine of the original vectors in double precision, ties (equal in DIGITS decimals) to the smaller id,
    the query's own id left out. Rows with a null id, a null, zero, non-finite or odd-sized vector (other than the
    commonest size), or one holding nulls take no part. Repeated rows count once; an id that stands
    with several vectors counts with each. Fewer than k others: all of them. An empty table gives an
    empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    usable, size = _usable(vectors, id_col, vector_col)
    rows = written(usable.distinct(), "ann-rows")
    first = Window.partitionBy("vector").orderBy("vec_id")
    classes = written(rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
                      .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                      .withColumn("cid", F.monotonically_increasing_id()), "ann-classes")
    queries = written(rows.where(F.col("vec_id") % every == 0).join(classes.select("vector", "cid"), "vector").select("vec_id", "cid"), "ann-queries")
    n = classes.count()
    window = max(256, round(share * n))
    if not n:
        return _ranked(spark.createDataFrame([], "qcid long, cid long"), classes, queries, k)
    asked = queries.select("cid").distinct()
    bounds = written(_bounds(classes, asked, n, size, window, curves), "ann-bounds")
    # The k-th best lower bound of each query, and whether all classes whose upper bound reaches it are known and few.
    best = Window.partitionBy("qcid").orderBy(F.desc("low"), "cid")
    least = (bounds.where("cid >= 0").withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
             .groupBy("qcid").agg(F.when(F.count(F.lit(1)) == k, F.min("low")).otherwise(F.lit(-2.0)).alias("least")))
    reach = bounds.join(least, "qcid", "left").where(F.col("least").isNull() | (F.col("high") >= F.col("least")))
    open_ = written(reach.groupBy("qcid").agg(F.count_if(F.col("cid") < 0).alias("rest"), F.count(F.lit(1)).alias("n"))
                    .where((F.col("rest") > 0) | (F.col("n") > rerank)).select("qcid"), "ann-open")
    pairs = reach.where("cid >= 0").join(open_, "qcid", "left_anti").select("qcid", "cid")
    n_open = open_.count()
    if n_open:
        pairs = pairs.unionByName(_exact(classes, open_, n, n_open, k))
    return _ranked(pairs, classes, queries, k)


def _up_to(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _exact(classes: DataFrame, open_: DataFrame, n: int, n_open: int, k: int) -> DataFrame:
    """(qcid, cid): the k + 1 best classes of each open query among all classes, in double precision; queries and
    classes meet in blocks."""
    rows, parts = -(-n // BLOCK), -(-n_open // BLOCK)
    first = F.col("ids")[0].alias("first")
    held = classes.select(F.pmod(F.xxhash64("cid"), F.lit(rows)).alias("block"), F.explode(_up_to(parts)).alias("part"),
                          F.lit(0).alias("asks"), "cid", first, "vector")
    asked = (classes.join(open_, classes["cid"] == open_["qcid"])
             .select(F.explode(_up_to(rows)).alias("block"), F.pmod(F.xxhash64("cid"), F.lit(parts)).alias("part"),
                     F.lit(1).alias("asks"), "cid", first, "vector"))
    schema = pa.schema([("qcid", pa.int64()), ("cid", pa.int64()), ("first", pa.int64()), ("near", pa.float64())])

    def search(batches):
        for _, _, asks, cid, least, vector in sorted_groups(batches, 2):
            unit = _unit(_matrix(vector.tolist(), "<f8"))
            here, ask = np.flatnonzero(asks == 0), np.flatnonzero(asks == 1)
            if not len(here):
                continue
            data, ids, firsts = unit[here], cid[here], least[here]
            for lo in range(0, len(ask), 64):
                own = ask[lo:lo + 64]
                near = np.round(unit[own] @ data.T, DIGITS)
                near[cid[own][:, None] == ids[None, :]] = -2
                cut = np.partition(near, -min(k + 1, len(here)), axis=1)[:, -min(k + 1, len(here))]
                q, c = np.nonzero((near >= cut[:, None]) & (near > -2))
                order = np.lexsort((firsts[c], -near[q, c], q))
                q, c = q[order], c[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, c = q[place <= k], c[place <= k]
                yield batch(schema, [cid[own][q], ids[c], firsts[c], near[q, c]])

    found = (held.unionByName(asked).repartition("block", "part").sortWithinPartitions("block", "part", "asks")
             .mapInArrow(search, "qcid long, cid long, first long, near double"))
    best = Window.partitionBy("qcid").orderBy(F.desc("near"), "first")
    return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("qcid", "cid")


def _bounds(classes: DataFrame, query_classes: DataFrame, n: int, size: int, window: int, curves: int) -> DataFrame:
    """(qcid, cid, low, high): bounds of the cosines of the classes within the windows of each query class that a piece reports,
    and with cid -1 the greatest upper bound of those that none does."""
    chance = min(1.0, SAMPLE / n)
    sample = [r["vector"] for r in classes.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 20)) <= int(chance * (1 << 20)))
              .select("vector").limit(2 * SAMPLE).collect()]
    model = Curves.fit(_unit(_matrix(sample, "<f8")) if sample else np.eye(size), size, curves)
    held = classes.sparkSession.sparkContext.broadcast(model)       # curves x size x DIMS numbers

    def keys(batches):
        schema = pa.schema([("curve", pa.int32()), ("key", pa.int64()), ("cid", pa.int64()), ("code", pa.binary())])
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                unit = _unit(_matrix(part.column(1).to_pylist(), "<f8"))
                code = _with_error(unit)
                for i, key in enumerate(held.value.keys(unit)):
                    yield batch(schema, [np.full(len(key), i, np.int32), key, part.column(0), code])

    def number(batches):
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), {}
        schema = pa.schema([("part", pa.int32()), ("curve", pa.int32()), ("at", pa.int64()), ("cid", pa.int64()), ("code", pa.binary())])
        for b in batches:
            curve = ints(b.column(0))
            at = np.zeros(len(curve), np.int64)
            for c in np.unique(curve).tolist():
                own = curve == c
                at[own] = seen.get(c, 0) + np.arange(own.sum())
                seen[c] = seen.get(c, 0) + int(own.sum())
            yield batch(schema, [np.full(len(curve), part, np.int32), b.column(0), at, b.column(2), b.column(3)])

    order = ["curve", "key", "cid"]
    placed = written(classes.select("cid", "vector").mapInArrow(keys, "curve int, key long, cid long, code binary")
                     .repartitionByRange(*order).sortWithinPartitions(*order)
                     .mapInArrow(number, "part int, curve int, at long, cid long, code binary"), "ann-curves")
    # One number per partition and curve it holds: partitions are ranges, so partitions + curves at most.
    sizes = sorted(tuple(r) for r in placed.groupBy("curve", "part").agg((F.max("at") + 1).alias("n")).collect())
    base, bases = {}, []
    for curve, part, count in sizes:
        bases.append((curve, part, base.get(curve, 0)))
        base[curve] = base.get(curve, 0) + count
    offsets = classes.sparkSession.createDataFrame(bases, "curve int, part int, base long")
    ranked = placed.join(F.broadcast(offsets), ["curve", "part"]).withColumn("rank", F.col("at") + F.col("base"))
    asked = ranked.join(query_classes, "cid", "left_semi").select("curve", "rank", "cid", "code")
    piece = F.explode(F.sequence(F.floor((F.greatest(F.col("rank") - window, F.lit(0))) / PIECE),
                                 F.floor((F.least(F.col("rank") + window, F.lit(n - 1))) / PIECE)))
    both = ranked.select("curve", F.floor(F.col("rank") / PIECE).alias("piece"), F.lit(0).alias("asks"), "rank", "cid", "code") \
        .unionByName(asked.select("curve", piece.alias("piece"), F.lit(1).alias("asks"), "rank", "cid", "code"))

    def search(batches):
        schema = pa.schema([("qcid", pa.int64()), ("cid", pa.int64()), ("low", pa.float32()), ("high", pa.float32())])
        for group in sorted_groups(batches, 2):
            _, _, asks, rank, cid, code = group
            raw = _matrix(code.tolist(), np.int8)
            off = np.ascontiguousarray(raw[:, -4:]).view("<f4")[:, 0]
            code = raw[:, :-4].astype(np.float32)
            code /= np.linalg.norm(code, axis=1, keepdims=True)
            here, ask = np.flatnonzero(asks == 0), np.flatnonzero(asks == 1)
            for lo in range(0, len(ask) if len(here) else 0, 256):
                own = ask[lo:lo + 256]
                out = (np.abs(rank[own][:, None] - rank[here][None, :]) > window) | (cid[own][:, None] == cid[here][None, :])
                high = code[own] @ code[here].T + (off[own][:, None] + off[here][None, :])
                high[out] = -9
                best = np.argpartition(-high, min(PER_PIECE, high.shape[1] - 1), axis=1)[:, :PER_PIECE]
                value = np.take_along_axis(high, best, axis=1)
                q, c = np.nonzero(value > -9)
                at = best[q, c]
                yield batch(schema, [cid[own][q], cid[here][at], value[q, c] - 2 * (off[own][q] + off[here][at]), value[q, c]])
                np.put_along_axis(high, best, -9, axis=1)
                rest = high.max(axis=1)
                more = np.flatnonzero(rest > -9)
                yield batch(schema, [cid[own][more], np.full(len(more), -1), np.full(len(more), -9, np.float32), rest[more]])

    found = (both.repartition("curve", "piece").sortWithinPartitions("curve", "piece", "asks")
             .mapInArrow(search, "qcid long, cid long, low float, high float"))
    return found.groupBy("qcid", "cid").agg(F.max("low").alias("low"), F.max("high").alias("high"))


def _ranked(pairs: DataFrame, classes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact scores of the candidate classes and of the query's own class, the k best ids of each query."""
    own = queries.select(F.col("cid").alias("qcid"), "cid").distinct()
    pairs = pairs.unionByName(own)
    asked = classes.select(F.col("cid").alias("qcid"), F.col("vector").alias("asked"))
    schema = pa.schema([("qcid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def score(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (_matrix(b.column(i).to_pylist(), "<f8") for i in (1, 2))
            x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
            cos = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            ids = b.column(3)
            sizes = np.diff(ids.offsets.to_numpy())
            yield batch(schema, [np.repeat(ints(b.column(0)), sizes), ids.flatten(), np.repeat(cos, sizes)])

    scored = (pairs.join(classes, "cid").join(asked, "qcid").select("qcid", "asked", "vector", "ids")
              .mapInArrow(score, "qcid long, vec_id long, score double"))
    best = Window.partitionBy("qcid").orderBy(F.desc(F.round("score", DIGITS)), "vec_id")
    # The k + 1 best ids of a class hold the k best of each of its queries, whichever of them that is.
    lists = (scored.groupBy("qcid", "vec_id").agg(F.max("score").alias("score"))
             .withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
             .groupBy("qcid").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best")))
    per_query = queries.select(F.col("vec_id").alias("query_id"), F.col("cid").alias("qcid")).join(lists, "qcid")
    kept = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (per_query.select("query_id", F.posexplode(kept).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")))
