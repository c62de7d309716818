"""Fixtures of the operator tests: awkward rows that every operator has to take."""

import random

import pytest

SF = "/root/testdata/sf0.001"

AWKWARD = [
    (None, "a row without an id, with a few words", "en", "s1"),
    (1, None, "en", "s1"),
    (2, "", None, "s2"),
    (3, " \n\t ", "en", None),
    (4, "12345 !!! 67", "en", "s1"),
    (5, "Same Text twice, same text twice. Über straße café.", "de", "s2"),
    (5, "Same Text twice, same text twice. Über straße café.", "de", "s2"),
    (6, "Same Text twice, same text twice. Über straße café.", "de", "s3"),
    (6, "another text under a used id 字 😀", "zh", "s3"),
    (7, "long " * 20_000, "en", "s4"),
    (-8, "x" * 30_000, "en", "s4"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids, texts and languages, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [(*r, "k", 1, b"d", 0.5) for r in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "key string, n long, digest binary, score double").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture
def rng():
    return random.Random(11)
