import pytest

import __spark_entry__ as entry_points
from checks.oracles import oracles
from checks.queries import QUERIES
from checks.verify import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_an_equivalent():
    assert QUERIES.keys() == oracles().keys()
    assert QUERIES.keys() <= entry_points.queries().keys()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    df = entry_points.queries()[name](spark, sf)
    assert compare(df, con, entry_points.oracle_sql()[name]) == ""
