import pytest

from compare import differences, second_engine
from foliosift.catalogue.oracles import ORACLES
from foliosift.catalogue.queries import QUERIES


@pytest.fixture(scope="module")
def connection(small):
    return second_engine(small)


def test_every_query_has_a_partner():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small, connection, name):
    rows, unequal = differences(QUERIES[name](spark, small), connection, ORACLES[name])
    assert rows > 0 and unequal == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
