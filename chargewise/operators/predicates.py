"""Filter predicates with the source rules' NULL behaviour spelled out.

Spark's `filter` keeps a row only when the predicate is TRUE, so NULL
acts as false. Some rules drop NULLs on purpose, others keep them; the
helper names say which.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_in_dropping_null(col: Column, values: Iterable) -> Column:
    """`col NOT IN (values)`: a NULL value is dropped."""
    return ~col.isin(list(values))


def not_in_keeping_null(col: Column, values: Iterable) -> Column:
    """`col NOT IN (values) OR col IS NULL`: a NULL value is kept."""
    return ~col.isin(list(values)) | col.isNull()


def outside_either(a: Column, a_values: Iterable, b: Column, b_values: Iterable) -> Column:
    """`a NOT IN (..) OR b NOT IN (..)` in three-valued logic.

    True iff at least one side is non-NULL and outside its list; a row with
    both sides NULL, or one side listed and the other NULL, is dropped.
    """
    return ~a.isin(list(a_values)) | ~b.isin(list(b_values))


def differs_dropping_null(col: Column, value) -> Column:
    """`col <> value`: a NULL value is dropped."""
    return col != F.lit(value)


def text_not_in_dropping_null(col: Column, values: Iterable[str]) -> Column:
    """Compare a key of any type to a list of text codes ('800554' matches 800554)."""
    return ~col.cast("string").isin(list(values))
