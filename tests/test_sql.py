"""Every registered query against its SQL on the smallest given tables."""

import compare
import pytest
from compare import SMALL

import __spark_entry__ as entry_points
from tidemart.plans import catalog, stream_catalog

SQL = entry_points.oracle_sql()
# The training-data queries are tested beside their brute-force versions; here they count with their SQL.
QUERIES = {name: query for name, query in entry_points.queries().items() if name in SQL}


def table_names():
    return {**catalog.TABLE_QUERIES, **stream_catalog.STREAM_QUERIES}.keys()


def test_every_query_has_sql():
    assert table_names() <= set(QUERIES) and set(SQL) <= set(entry_points.queries())


def test_flagship(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["dt", "tm_name", "order_amount"] and rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SMALL), con, SQL[name]) == ""
