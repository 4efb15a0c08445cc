"""Every query with check SQL gives the same columns, rows and values as DuckDB."""

import __spark_entry__ as entry_points
import pytest
from checking import compare, duck

QUERIES, CHECK_SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    return duck(folder)


def test_check_sql_belongs_to_a_query():
    assert set(CHECK_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query_matches_sql(spark, folder, db, name):
    difference = compare(QUERIES[name](spark, folder), db, CHECK_SQL[name])
    assert difference is None, difference
