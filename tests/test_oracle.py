"""Every registered query with an SQL oracle, on whole tables at the smallest scale."""

import pytest

from quillrank.plans.catalog import ORACLES, QUERIES
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert difference(got, con.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    import __spark_entry__ as contract
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
