"""A Bloom filter of given size over a table of 64-bit keys, built in tasks and broadcast by its users."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from chargewise.llm.common import batch, ints, rows_of

_SLICES = 64


def _bit_places(keys: np.ndarray, bits: int):
    mask = np.uint64((1 << bits) - 1)
    return keys & mask, (keys >> np.uint64(20)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits), (keys >> np.uint64(64 - bits))


class Filter:
    """A Bloom filter of 2^bits bits over 64-bit keys."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for place in _bit_places(keys, self.bits):
            out &= self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1) == 1
        return out


def build_filter(keys: DataFrame, bits: int) -> Filter:
    """A filter of a table of keys (one long column): slices are merged in tasks, the driver gets 2^bits bits."""
    size = (1 << bits) // 8 // _SLICES
    schema = pa.schema([("slice", pa.int32()), ("data", pa.binary())])

    def fill(batches):
        data = np.zeros((1 << bits) // 8, np.uint8)
        for b in batches:
            for place in _bit_places(ints(b.column(0)).view(np.uint64), bits):
                np.bitwise_or.at(data, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        for i in range(_SLICES):
            part = data[i * size:(i + 1) * size]
            if part.any():
                yield batch(schema, [[i], [zstandard.compress(part.tobytes(), 1)]])

    def merge(batches):
        merged: dict[int, np.ndarray] = {}
        for i, data in rows_of(batches, 16):
            part = np.frombuffer(zstandard.decompress(data), np.uint8)
            merged[i] = part | merged[i] if i in merged else part
        for i, part in merged.items():
            yield batch(schema, [[i], [zstandard.compress(part.tobytes(), 1)]])

    data = np.zeros((1 << bits) // 8, np.uint8)
    for r in keys.mapInArrow(fill, "slice int, data binary").repartition(_SLICES, "slice").mapInArrow(merge, "slice int, data binary").collect():
        data[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(zstandard.decompress(bytes(r["data"])), np.uint8)
    return Filter(bits, data)
