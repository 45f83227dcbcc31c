"""Every query with a checking text, on the smallest tables."""

import pytest

from oracle import compare, connect
from staymill.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, small, con):
    result = compare(QUERIES[name](spark, small), con, ORACLES[name])
    assert result in ("", "no rows on both sides")


def test_every_text_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
