"""Every registered query against its independent DuckDB SQL (the driver's gate)."""

import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tools.compare import digest, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_job_query_has_oracle_sql():
    from chargewise import catalog_queries
    assert set(catalog_queries.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(SF_ORACLE), reason="test data missing")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]
