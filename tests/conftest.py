import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from chargewise.session import local_session
    warehouse = tempfile.mkdtemp(prefix="chargewise-warehouse-")
    session = local_session("*", shuffle_partitions=8, app="chargewise-tests",
                            extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


def rows(df, *cols):
    """Sorted list of tuples (None sorts first) for order-insensitive asserts."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
