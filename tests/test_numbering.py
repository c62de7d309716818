"""Row numbers and generated ids don't depend on the partition layout."""

import random

from pyspark.sql import functions as F

from chargewise.operators import numbering
from chargewise.operators.numbering import number_rows
from chargewise.plans.combine import combine_frames
from tests.conftest import rows


def data(rng, n):
    return [(rng.choice(["a", "b", None]), rng.choice([1.5, None, -2.0]), rng.randrange(4)) for _ in range(n)]


def expected(values):
    order = sorted(values, key=lambda r: tuple((v is not None, v) for v in r))
    return sorted(((*r, i + 1) for i, r in enumerate(order)), key=lambda r: r[-1])


def numbered(df, **options):
    return sorted((tuple(r) for r in number_rows(df, "ID", **options).collect()), key=lambda r: r[-1])


def test_numbers_are_those_of_the_sorted_rows(spark, monkeypatch):
    values = data(random.Random(4), 300)                    # many repeated rows
    df = spark.createDataFrame(values, "s string, x double, n int")
    for parts in (1, 7, 200):
        assert numbered(df.repartition(parts), partitions=parts) == expected(values)
    monkeypatch.setattr(numbering, "COPY_CHUNK", 5)         # copies of one row over several chunks
    assert numbered(df) == expected(values)
    assert numbered(df.limit(0)) == []


def test_generated_ids_are_the_same_at_1_and_200_partitions(spark):
    feed = spark.range(500).select((F.col("id") * 37 % 500).alias("A"), F.lit("x").alias("B"))
    got = [rows(combine_frames({"1": feed.repartition(p)}, "1").frame) for p in (1, 200)]
    assert got[0] == got[1] and sorted(int(r[2]) for r in got[0]) == list(range(1, 501))
