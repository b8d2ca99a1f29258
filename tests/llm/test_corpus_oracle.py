"""Every query of the folder that has a DuckDB statement, and a first look at the others."""

import pytest

from netvigil.llm import registry
from tools.compare import connect, difference, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    ours = spark_rows(registry.QUERIES[name](spark, SF_DIR))
    assert difference(ours, duck_rows(duck, registry.ORACLE_SQL[name])) is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_has_a_row_per_row(spark, duck, name):
    table = {"op7_nn_descent": "embeddings", "op10_site_style": "pages"}.get(name, "documents")
    if name == "op11_spelling_variants":  # a row per word
        assert registry.QUERIES[name](spark, SF_DIR).count() > 0
        return
    count = duck.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    assert registry.QUERIES[name](spark, SF_DIR).count() >= count
