"""The aligned union's column types."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargewise.operators.union import TypeClash, aligned_union, common_type
from tests.conftest import rows

I, L, S, DBL, DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.DateType()
NTZ, TZ = T.TimestampNTZType(), T.TimestampType()


@pytest.mark.parametrize("types, want", [
    ([I, I], I), ([I, L], L), ([T.ShortType(), T.ByteType()], T.ShortType()), ([T.NullType(), I], I), ([T.NullType()], T.NullType()),
    ([S, I], S), ([L, S, T.DecimalType(4, 1)], S), ([S, DBL], S), ([S, DATE], None), ([S, T.BooleanType()], None),
    ([I, T.DecimalType(10, 2)], T.DecimalType(12, 2)), ([T.DecimalType(10, 4), T.DecimalType(18, 2)], T.DecimalType(20, 4)),
    ([T.DecimalType(38, 0), T.DecimalType(10, 10)], None), ([L, T.DecimalType(38, 30)], None),
    ([I, DBL], DBL), ([T.FloatType(), DBL], DBL), ([L, DBL], None), ([T.DecimalType(12, 2), DBL], None), ([T.DecimalType(15, 0), DBL], DBL),
    ([DATE, NTZ], NTZ), ([DATE, TZ], TZ), ([NTZ, TZ], None), ([DATE, I], None), ([T.ArrayType(I), T.ArrayType(L)], None),
])
def test_common_type(types, want):
    assert common_type(types) == common_type(types[::-1]) == want


def test_text_ids_keep_their_zeros_beside_numbers(spark):
    a = spark.createDataFrame([("007",), ("x1",)], "ID string")
    b = spark.createDataFrame([(7,), (10 ** 15,)], "ID long")
    assert rows(aligned_union([a, b])) == [("007",), ("1000000000000000",), ("7",), ("x1",)]


def test_widest_exact_types_and_missing_columns(spark):
    a = spark.createDataFrame([(1, D("1.25"), dt.date(2025, 1, 2))], "n int, amount decimal(10,2), day date")
    b = spark.createDataFrame([(10 ** 12, 3, dt.datetime(2025, 1, 2, 3))], "n long, amount int, day timestamp_ntz")
    c = spark.range(1).select(F.lit(None).alias("n"))
    u = aligned_union([a, b, c])
    assert [f.dataType for f in u.schema.fields] == [T.DecimalType(12, 2), NTZ, L] and u.columns == ["amount", "day", "n"]
    assert rows(u) == [(None, None, None), (D("1.25"), dt.datetime(2025, 1, 2), 1), (D("3.00"), dt.datetime(2025, 1, 2, 3), 10 ** 12)]


def test_a_clash_names_the_columns_and_the_feeds(spark):
    a = spark.createDataFrame([(1.5, True)], "x double, flag boolean")
    b = spark.createDataFrame([(D("1.50"), "Y")], "x decimal(18,2), flag string")
    with pytest.raises(TypeClash, match="flag: boolean in 702, string in 710; x: double in 702, decimal.18,2. in 710"):
        aligned_union([a, b], names=["702", "710"])
