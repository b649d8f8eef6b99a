"""Queries on places: ranges of lines, headings above a block, repeated labels, ordered comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from folianth.functions.rules import as_sql, ordinal_prefix_sql
from folianth.operators import lookup as L
from folianth.plans import pages
from folianth.plans.navigation import PLACED_SQL, placed
from folianth.plans.relations import LINES_SQL, lines
from folianth.sources.tables import table


def printed_range_expand(spark, d):
    """Characters and lines between the first and the last list item of each document, ends included."""
    text = lines(spark, d).select(F.col("doc_id").cast("string").alias("book"), F.lit(0).alias("file_index"), F.col("line_no").cast("int").alias("block"), F.col("line").alias("text"))
    items = text.where(F.col("text").startswith("- ")).groupBy("book").agg(F.min("block").alias("start_block"), F.max("block").alias("stop_block"))
    ranges = items.select("book", F.lit(1).alias("range_id"), F.lit(0).alias("start_file"), "start_block", F.lit(0).alias("stop_file"), "stop_block")
    return L.range_expand(ranges, text).groupBy("book").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("text")).alias("chars"))


def chapter_nesting(spark, d):
    """Every third-level heading and list item with the first- and second-level headings above it."""
    b = pages.blocks(spark, d).select(F.col("doc_id").cast("string").alias("book"), F.col("block_no").alias("seq"), "tag", "text")
    return L.nested_under(b, ["h1", "h2"]).where(F.col("tag").isin("h3", "li"))


def later_duplicate_labels(spark, d):
    return L.later_duplicates(placed(spark, d).where(F.col("book").isNotNull()))


def spec_zip_drift(spark, d):
    """Printed lines against labels, row by row in order: how many places of each book differ."""
    printed = table(spark, d, "printed_lines").where("book IS NOT NULL").groupBy("book", "line_no").agg(F.min("line").alias("text")).select("book", F.col("line_no").cast("bigint").alias("seq"), "text")
    labels = placed(spark, d).where("book IS NOT NULL").select("book", "seq", F.col("label").alias("text"))
    return L.ordered_zip(printed, labels, ["text"]).groupBy("book").agg(F.count(F.lit(1)).alias("differences"))


_LATER = f"keyed AS (SELECT book, entry_id, seq, {as_sql('key_printed', 'label')} AS key, {ordinal_prefix_sql('label')} AS ordinal FROM placed WHERE book IS NOT NULL)"
SQL = {
    "printed_range_expand": f"WITH {LINES_SQL}, r AS (SELECT doc_id, min(line_no) AS a, max(line_no) AS b FROM lines WHERE starts_with(line, '- ') GROUP BY doc_id) SELECT CAST(l.doc_id AS VARCHAR) AS book, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM lines l JOIN r ON r.doc_id = l.doc_id AND line_no BETWEEN a AND b GROUP BY l.doc_id",
    "chapter_nesting": f"WITH {pages._BLOCKS}, n AS (SELECT *, last_value(CASE WHEN tag = 'h1' THEN text END IGNORE NULLS) OVER w AS h1, max(CASE WHEN tag = 'h1' THEN block_no END) OVER w AS at1, last_value(CASE WHEN tag = 'h2' THEN text END IGNORE NULLS) OVER w AS second, max(CASE WHEN tag = 'h2' THEN block_no END) OVER w AS at2 FROM blocks WINDOW w AS (PARTITION BY doc_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT CAST(doc_id AS VARCHAR) AS book, block_no AS seq, tag, text, h1, CASE WHEN at2 > coalesce(at1, -1) THEN second END AS h2 FROM n WHERE tag IN ('h3', 'li')",
    "later_duplicate_labels": f"WITH {PLACED_SQL}, {_LATER} SELECT DISTINCT a.book, a.entry_id FROM keyed a JOIN keyed b ON a.book = b.book AND b.seq > a.seq AND (a.key <> '' AND b.key <> '' AND (contains(b.key, a.key) OR contains(a.key, b.key)) OR a.ordinal <> '' AND a.ordinal = b.ordinal)",
    "spec_zip_drift": f"WITH {PLACED_SQL}, p AS (SELECT book, row_number() OVER (PARTITION BY book ORDER BY line_no) AS i, text FROM (SELECT book, line_no, min(line) AS text FROM printed_lines WHERE book IS NOT NULL GROUP BY book, line_no)), l AS (SELECT book, row_number() OVER (PARTITION BY book ORDER BY seq) AS i, label AS text FROM placed WHERE book IS NOT NULL) SELECT coalesce(p.book, l.book) AS book, count(*) AS differences FROM p FULL JOIN l ON p.book = l.book AND p.i = l.i WHERE p.i IS NULL OR l.i IS NULL OR p.text IS DISTINCT FROM l.text GROUP BY 1",
}
QUERIES = {k: globals()[k] for k in SQL}
