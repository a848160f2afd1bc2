"""Every registered query with SQL against DuckDB on the same files; the others must yield rows.

No plan may hold a pair product or row-wise Python.
"""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def sorted_rows(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in plan
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted_rows(rows, df.columns) == sorted_rows(cursor.fetchall(), columns)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
