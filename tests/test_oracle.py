"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as registry
from check import DATA, compare, connect

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    sql = registry.oracle_sql().get(name)
    assert compare(spark, con, registry.queries()[name], sql, f"{DATA}/{SF}") == ""


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["group_id", "rank", "token", "cnt", "total", "score"]


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
