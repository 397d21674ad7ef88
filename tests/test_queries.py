import pytest

from strataforge.queries import QUERIES, SQL

from .oracle import compare, connect


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, con, name):
    compare(con, QUERIES[name](spark, data), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
