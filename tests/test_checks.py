"""Every registered query with SQL gives the same rows as the SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import __spark_entry__ as registered  # noqa: E402
from compare import lines  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(FOLDER) if os.path.isdir(FOLDER) else []:
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, con, name):
    df = registered.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    out = con.execute(sql)
    columns = [d[0] for d in out.description]
    assert sorted(columns) == sorted(df.columns)
    assert lines(df.columns, rows) == lines(columns, out.fetchall())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() > 0
