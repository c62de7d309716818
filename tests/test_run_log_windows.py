"""The run log's monthly windows read the freight histories once."""

from chargewise import catalog_queries as CQ
from tests.conftest import SF_SMALL, rows
from tools.plans import METADATA_LENGTH, plan_text, scans


def test_monthly_runs_read_a_slice_of_the_histories(spark):
    inputs = CQ.inputs_for(spark, SF_SMALL)
    old = spark.conf.get(METADATA_LENGTH)
    spark.conf.set(METADATA_LENGTH, "1000")
    try:
        months = CQ._months()[:2]
        found = {(run.job, run.start): out for run, out in CQ._runs_706(inputs, months)}
        alone = {(run.job, run.start): out for month in months for run, out in CQ._runs_706(inputs, [month])}
        assert len(found) == 4
        for key, out in found.items():
            assert not {s[0] for s in scans(plan_text(out))} & {"ltl", "ltl_yw"}
            assert rows(out) == rows(alone[key])
        assert sum(len(rows(out)) for out in found.values())
    finally:
        spark.conf.set(METADATA_LENGTH, old)
