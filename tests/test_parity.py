"""Every registered query against its DuckDB text, at the smallest scale."""

import pytest
from conftest import SMALL
from parity import compare, duck_connection

from queries.registry import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    build, sql = QUERIES[name]
    df = build(spark, SMALL)
    if sql is None:
        assert df.count() > 0
        return
    assert compare(df, duck, sql) in (None, "empty")


def test_compare_notices_differences(spark, duck):
    build, sql = QUERIES["top_orders"]
    assert compare(build(spark, SMALL), duck, sql.replace("LIMIT 10", "LIMIT 9")).startswith("rows differ")
    assert compare(build(spark, SMALL), duck, sql.replace("AS amount", "AS total").replace("amount DESC", "total DESC")).startswith("columns differ")


def test_contract():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert not [n for n in QUERIES if n.startswith(("op_", "pipeline"))]
