"""Every query against its SQL counterpart, and the driver contract."""

import __spark_entry__ as contract
import pytest

from tests.compare import connect, difference
from voltmesh.plans.catalogue import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    assert difference(df, con, SQL[name]) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
