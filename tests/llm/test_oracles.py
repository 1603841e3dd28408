"""Text queries against their SQL counterparts."""

import pytest

from eventloom.llm import queries
from tests.compare import connect, difference
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None
