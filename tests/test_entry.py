"""Every registered core query runs on the smallest tables; those with SQL agree with it, and none is empty on both sides."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from folianth.plans import catalog

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
#: Nothing on the smallest tables meets these.
MAY_BE_EMPTY = {"inventory_copies", "coordinate_drift", "worst_coverage_topk", "coverage_report", "coverage_gate", "unexplained_additions"}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6f}"
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert rows or name in MAY_BE_EMPTY
    if name in SQL:
        got = duck.execute(SQL[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())


def test_names():
    assert set(SQL) <= set(QUERIES) and "page_quality_audit" in QUERIES
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
