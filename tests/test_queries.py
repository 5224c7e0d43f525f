"""Every registered query against its SQL on the small tables, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
import catalog
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
QUERIES, SQL = catalog.QUERIES, catalog.SQL


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", QUERIES)
def test_query(key, spark, duck):
    df = QUERIES[key](spark, SF)
    got, columns = rows_of(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if key not in SQL:
        assert got
        return
    cur = duck.execute(SQL[key])
    want, want_columns = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert columns == want_columns
    assert got == want


def test_every_check_has_its_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"adf_screen"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["card", "label", "as_of", "value", "light"] and df.count() == 5
