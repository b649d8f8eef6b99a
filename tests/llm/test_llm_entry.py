"""Every registered llm query runs on the smallest tables; those with SQL agree with it."""

import os

import duckdb
import pytest

from folianth.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(str([r[c] for c in columns]) for r in df.collect())
    if name in queries.oracle_sql():
        got = duck.execute(queries.oracle_sql()[name])
        at = [[d[0] for d in got.description].index(c) for c in columns]
        assert rows == sorted(str([r[i] for i in at]) for r in got.fetchall())
