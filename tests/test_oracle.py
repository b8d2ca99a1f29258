"""Every registered query against its DuckDB statement, and the driver contract."""

import pytest

import __spark_entry__ as contract
from netvigil import oracle, registry
from tools.compare import connect, difference, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours = spark_rows(registry.queries()[name](spark, SF_DIR))
    assert difference(ours, duck_rows(duck, oracle.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(oracle.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert registry.queries()[name](spark, SF_DIR).count() > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
