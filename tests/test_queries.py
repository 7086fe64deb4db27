import pytest
from compare import check
from conftest import SMALL

from cohortloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, name):
    check(spark, QUERIES[name], SQL[name], SMALL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() >= 0 and df.columns


def test_entry_module():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
