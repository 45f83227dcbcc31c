"""Every query of the training-data operators that has a checking text, on the smallest tables."""

import pytest

from oracle import compare, connect
from staymill.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, small):
    assert compare(QUERIES[name](spark, small), connect(small), ORACLES[name]) == ""
