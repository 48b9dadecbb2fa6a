"""Every registered query against its SQL on the smallest tables."""

import pytest

from statloom.queries import all_queries
from tests.oracle import check, connect

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    assert check(spark, con, SF, QUERIES[name]) == []
