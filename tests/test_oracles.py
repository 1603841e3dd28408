"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as contract
from eventloom.checks.oracle import ORACLES
from eventloom.checks.queries import QUERIES
from tests.compare import connect, difference
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:2] == ["user_id", "date"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None
