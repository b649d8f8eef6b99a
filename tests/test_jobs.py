"""The order of all jobs, against the SQL twin without its limit."""

import os

import duckdb
import pytest

from folianth.plans import pages

DATA = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_every_book_has_its_place(spark):
    con = duckdb.connect()
    con.execute(f"create view content_blocks as select * from '{DATA}/content_blocks.parquet'")
    want = con.execute(pages.SQL["job_order"].removesuffix(" LIMIT 100")).fetchall()
    assert len(want) > 100
    assert [tuple(r) for r in pages.job_order(spark, DATA).collect()] == want
    assert [tuple(r) for r in pages.job_order(spark, DATA, 7).collect()] == want[:7]
    ranks = pages.job_ranks(spark, DATA).orderBy("rank").collect()
    assert [(r["rank"], r["book"], r["size"]) for r in ranks] == [(k + 1, *w) for k, w in enumerate(want)]
