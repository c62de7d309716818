"""Property tests: the predicate helpers keep exactly the rows SQL keeps (DuckDB as reference).

Random small frames with NULLs; each helper's filter is compared with the
SQL text of the rule it stands for.
"""

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chargewise.operators import joins, predicates as pred

VALUES = st.sampled_from(["a", "b", "c", None])
ROWS = st.lists(st.tuples(VALUES, VALUES), min_size=0, max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def spark_ids(spark, data, predicate):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(data)], "id int, a string, b string")
    return sorted(r.id for r in df.filter(predicate).select("id").collect())


def duck_ids(data, where):
    t = pd.DataFrame([(i, a, b) for i, (a, b) in enumerate(data)], columns=["id", "a", "b"]).astype(
        {"id": "int64", "a": "object", "b": "object"})
    if t.empty:
        return []
    con = duckdb.connect()
    con.register("t", t)
    return sorted(r[0] for r in con.execute(f"SELECT id FROM t WHERE {where}").fetchall())


@SETTINGS
@given(ROWS)
def test_outside_either_matches_sql(spark, data):
    got = spark_ids(spark, data, pred.outside_either(F.col("a"), ["a"], F.col("b"), ["b", "c"]))
    assert got == duck_ids(data, "a NOT IN ('a') OR b NOT IN ('b', 'c')")


@SETTINGS
@given(ROWS)
def test_null_rules_match_sql(spark, data):
    assert spark_ids(spark, data, pred.not_in_keeping_null(F.col("a"), ["a", "b"])) == \
        duck_ids(data, "a NOT IN ('a', 'b') OR a IS NULL")
    assert spark_ids(spark, data, pred.not_in_dropping_null(F.col("a"), ["a", "b"])) == \
        duck_ids(data, "a NOT IN ('a', 'b')")
    assert spark_ids(spark, data, pred.differs_dropping_null(F.col("a"), "a")) == duck_ids(data, "a <> 'a'")


@SETTINGS
@given(ROWS, st.lists(VALUES, max_size=5))
def test_anti_join_matches_not_exists(spark, data, keys):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(data)], "id int, a string, b string")
    k = spark.createDataFrame([(v,) for v in keys], "a string")
    got = sorted(r.id for r in joins.anti_keeping_null(df, k, "a").select("id").collect())
    con = duckdb.connect()
    t = pd.DataFrame([(i, a) for i, (a, _) in enumerate(data)], columns=["id", "a"]).astype({"a": "object"})
    kk = pd.DataFrame({"a": pd.Series(keys, dtype="object")})
    if t.empty:
        assert got == []
        return
    con.register("t", t)
    con.register("k", kk)
    want = sorted(r[0] for r in con.execute(
        "SELECT id FROM t WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.a = t.a)").fetchall())
    assert got == want
