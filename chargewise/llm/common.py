"""Shared helpers: the cluster's scratch folder, written intermediates, Arrow column access."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dir: str | None = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded(df: DataFrame) -> DataFrame:
    """`df`, in a session whose Arrow batches are bounded by bytes: by rows alone, long texts make them large."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder that the session names in `spark.checkpoint.dir`.

    Where the setting is absent a temporary folder is used, but only with a local master: there the
    driver and the tasks are one process. On a cluster that would lose data, so it is an error.
    """
    global _local_dir
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        _local_dir = _local_dir or tempfile.mkdtemp(prefix="chargewise-llm-")
        base = _local_dir
    return f"{base.rstrip('/')}/chargewise-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` as a Parquet table in the scratch folder: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    bounded(df).write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunk_name(number: int) -> str:
    """Name of a task's chunk: the same at every attempt, so what is computed again after a lost executor fits what was sent."""
    return f"{TaskContext.get().partitionId():08x}-{number:06x}"


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and nothing else; a null text counts as the empty text."""
    return bounded(docs).select(*[F.col(c) for c in columns], F.coalesce(F.col("text"), F.lit("")).alias("text"))


def whole_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """`docs` as one column `row`, beside the named columns: whatever names it has, none can clash with others. `row.*` gives it back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[F.col(c) for c in columns])


def free_name(docs: DataFrame, name: str) -> str:
    """`name`, with underscores behind it as long as `docs` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema)], schema=schema)


def ints(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def slices_of(column: pa.Array, size: int = 512):
    """The values of an Arrow column as lists of Python objects, a few at a time."""
    for lo in range(0, len(column), size):
        yield column.slice(lo, size).to_pylist()


def rows_of(batches, size: int = 512):
    """The rows of Arrow batches as Python tuples, turned into Python objects a few at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, size):
            yield from zip(*(c.to_pylist() for c in b.slice(lo, size).columns))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers as compressed byte planes."""
    out = []
    for a in arrays:
        width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
        planes = np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
        out.append(len(a).to_bytes(8, "little") + width.to_bytes(1, "little") + b"".join(
            len(z).to_bytes(8, "little") + z for z in (zstandard.compress(planes[:, i].tobytes(), 3) for i in range(width))))
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays that `pack` was given, as unsigned 32-bit or, where needed, 64-bit integers."""
    at, out = 0, []
    while at < len(data):
        n, width = int.from_bytes(data[at:at + 8], "little"), data[at + 8]
        at += 9
        a = np.zeros(n, np.uint32 if width <= 4 else np.uint64)
        for i in range(width):
            size = int.from_bytes(data[at:at + 8], "little")
            a |= np.frombuffer(zstandard.decompress(data[at + 8:at + 8 + size], max_output_size=n), np.uint8).astype(a.dtype) << a.dtype.type(8 * i)
            at += 8 + size
        out.append(a)
    return out


_BYTE = np.random.default_rng(1612).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(n: int, base: int) -> np.ndarray:
    """base^0 to base^(n-1), modulo 2^64."""
    if len(_powers.get(base, ())) < n:
        held = np.full(max(n + (n >> 1), 1 << 20), base, np.uint64)      # room for the next, somewhat longer, run
        held[0] = 1
        _powers[base] = np.cumprod(held, dtype=np.uint64)
    return _powers[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run, wherever it stands: sums of powers, one pass over the data."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _power(len(data), _BASE), dtype=np.uint64)))
    h = (total[ends] - total[starts]) * _power(len(data) + 1, pow(_BASE, -1, 1 << 64))[starts]
    return h ^ (ends - starts).astype(np.uint64)


def key_runs(keys: list[np.ndarray]) -> np.ndarray:
    """Start offsets of the runs of equal keys (and the end) in arrays sorted by them."""
    n = len(keys[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), n)


def sorted_groups(batches, n_keys: int):
    """Groups of a partition that is sorted by its first `n_keys` columns, as lists of numpy columns.

    A group may span Arrow batches; only the open group is held back, so memory is bounded by the
    largest group, which every caller bounds.
    """
    held: list[list[np.ndarray]] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        cols = [ints(c) for c in b.columns]
        cuts = key_runs(cols[:n_keys])
        if held and all(held[-1][k][-1] == cols[k][0] for k in range(n_keys)):
            held.append([c[:cuts[1]] for c in cols])
            if len(cuts) == 2:
                continue
            first = 1
        else:
            first = 0
        if held:
            yield [np.concatenate(parts) for parts in zip(*held)]
        for lo, hi in zip(cuts[first:-2], cuts[first + 1:-1]):
            yield [c[lo:hi] for c in cols]
        held = [[c[cuts[-2]:] for c in cols]]
    if held:
        yield [np.concatenate(parts) for parts in zip(*held)]
