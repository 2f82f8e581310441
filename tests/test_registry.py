"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as registry
import query_registry
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="tables not present")
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(query_registry.QUERIES))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, FOLDER)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0
