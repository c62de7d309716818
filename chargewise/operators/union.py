"""Union of frames with different columns and different types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_EXACT_IN_DOUBLE = 15       # decimal digits


class TypeClash(ValueError):
    """Frames give one column types that no type holds without loss."""


def superset_columns(frames: Sequence[DataFrame]) -> list[str]:
    return sorted({c for f in frames for c in f.columns})


def common_type(types: Sequence[T.DataType]) -> T.DataType | None:
    """The type that holds the values of all `types` exactly; None if there is none.

    Text wins over numbers (an id '007' stays as it is, a number becomes its digits). Integers take the widest
    integer, integers and decimals a decimal with the most places on both sides, integers of up to 15 digits and
    floating point a double; a date beside a timestamp becomes its midnight.
    """
    known = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if not known:
        return T.NullType()
    if len(known) == 1:
        return known[0]
    if any(isinstance(t, T.StringType) for t in known):
        others = [t for t in known if not isinstance(t, T.StringType)]
        return T.StringType() if all(isinstance(t, T.NumericType) for t in others) else None
    if all(isinstance(t, T.NumericType) for t in known):
        return _common_number(known)
    stamps = [t for t in known if not isinstance(t, T.DateType)]
    if len(stamps) == 1 and isinstance(stamps[0], (T.TimestampType, T.TimestampNTZType)):
        return stamps[0]
    return None


def _common_number(types: list[T.DataType]) -> T.DataType | None:
    whole = [t for t in types if t in _DIGITS]
    if len(whole) == len(types):
        return max(whole, key=_DIGITS.__getitem__)
    decimals = [t for t in types if isinstance(t, T.DecimalType)]
    digits = max([_DIGITS[t] for t in whole] + [t.precision - t.scale for t in decimals], default=0)
    scale = max([t.scale for t in decimals], default=0)
    if len(whole) + len(decimals) == len(types):
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    return T.DoubleType() if scale == 0 and digits <= _EXACT_IN_DOUBLE else None


def common_schema(frames: Sequence[DataFrame], names: Sequence[str] | None = None) -> Mapping[str, T.DataType]:
    """Type of each column of the sorted superset; a `TypeClash` lists every column that has none."""
    names = names or [f"frame {i + 1}" for i in range(len(frames))]
    out, clashes = {}, []
    for c in superset_columns(frames):
        given = [(n, f.schema[c].dataType) for n, f in zip(names, frames) if c in f.columns]
        out[c] = common_type([t for _, t in given])
        if out[c] is None:
            clashes.append(f"{c}: " + ", ".join(f"{t.simpleString()} in {n}" for n, t in given))
    if clashes:
        raise TypeClash("no common type for " + "; ".join(clashes))
    return out


def aligned_union(frames: Sequence[DataFrame], distinct: bool = True, names: Sequence[str] | None = None) -> DataFrame:
    """Union by column name over the sorted superset of columns, each in its common type.

    A column a frame lacks is NULL in its rows. The union removes duplicate
    rows when two or more frames are combined (set union); a single frame
    passes through with its duplicates, as no union takes place, and so do all
    with `distinct=False`. `names`: what an error calls the frames.
    """
    if not frames:
        raise ValueError("aligned_union needs at least one frame")
    types = common_schema(frames, names)

    def aligned(f: DataFrame) -> DataFrame:
        return f.select(*(F.col(f"`{c}`").cast(t).alias(c) if c in f.columns else F.lit(None).cast(t).alias(c)
                          for c, t in types.items()))

    merged = reduce(lambda a, b: a.unionByName(b), [aligned(f) for f in frames])
    return merged.distinct() if distinct and len(frames) > 1 else merged
