"""Queries on nested records: the flat tables of review specs and layout items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianth.operators import layout, nested, resolve
from folianth.plans.relations import entries, lines
from folianth.sources.tables import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.node_links(table(spark, sf_dir, "spec_records"), table(spark, sf_dir, "content_blocks"))


def entry_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.triples(table(spark, sf_dir, "spec_records"), "record_id", "body", marker="label", embedded=("children",))


def p4_entries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of all review specs as one flat table with links to their parents; every node is a row, its label may be null."""
    lists = ["search", "deviation.by[].step"]
    entries = nested.objects(table(spark, sf_dir, "spec_records"), "record_id", "body", ["label", "search", "exact", "occurrence", "start_file", "max_file", "window", "file", "block", "expect", "printed", "deviation.reason", "deviation.by[].step"], lists, marker="label", embedded=("children",))
    return entries.withColumnsRenamed({"deviation.reason": "deviation_reason", "deviation.by[].step": "deviation_steps"})


def p4_entry_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that stands in an array of an entry, at whatever key: the child table of p4_entries_table."""
    return nested.elements(entry_triples(spark, sf_dir))


def p4_entry_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and numbers of every entry, without its lists."""
    columns = ["label", "file", "block", "expect", "printed", "occurrence"]
    return nested.objects(table(spark, sf_dir, "spec_records"), "record_id", "body", columns, marker="label", embedded=("children",)).select("rec_id", "node_path", *columns)


def p4_spec_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of all review specs in one table for each repeated ancestor, with their values by key."""
    return nested.grouped(nested.triples(table(spark, sf_dir, "spec_records"), "record_id", "body", embedded=("children",)))


def p4_content_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects below the content of all layout items in one table for each repeated ancestor, with their values by key."""
    return nested.grouped(nested.triples(table(spark, sf_dir, "content_blocks"), "block_id", "item", root="content"))


def p4_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many objects and values each group of the layout items has."""
    g = p4_content_groups(spark, sf_dir)
    return g.groupBy("table").agg(F.count(F.lit(1)).alias("objects"), F.sum(F.size("fields")).alias("values"), F.count_if(F.col("parent_path") != "").alias("linked"))


def markdown_rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rich form of every layout item that has a text."""
    return layout.rich(table(spark, sf_dir, "content_blocks"))


def markdown_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Markdown of every layout item that has a text."""
    return layout.rendered(table(spark, sf_dir, "content_blocks"))


def markdown_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Markdown of every book, in parts of bounded size."""
    blocks = table(spark, sf_dir, "content_blocks")
    titles = table(spark, sf_dir, "spec_books").where(F.col("book").isNotNull()).groupBy("book").agg(F.col("book").alias("title"), F.min("source").alias("author"))
    return layout.parts(layout.rendered(blocks), titles=titles)


def resolve_search_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unplaced entry looked for in the chapters of its book, the others taken as they are placed."""
    e = entries(spark, sf_dir)
    index = F.nullif(F.regexp_extract("file", r"([0-9]+)", 1), F.lit("")).cast("int")
    asked = e.select("book", "entry_id", "seq", "label", "search", "exact", "occurrence", "start_file", "max_file", F.col("window_blocks").alias("window"), index.alias("file_index"), "block")
    chapters = table(spark, sf_dir, "documents").where(F.col("book").isNotNull() & F.col("chapter_no").isNotNull()).groupBy("book", "chapter_no").agg(F.min("doc_id").alias("doc_id"))
    text = lines(spark, sf_dir).drop("book").join(chapters, "doc_id").where(F.length(F.trim("line")) > 0)
    order = Window.partitionBy("doc_id").orderBy("line_no")
    blocks = text.select("book", F.col("chapter_no").alias("file_index"), (F.row_number().over(order) - 1).alias("block"), F.col("line").alias("text"))
    books = table(spark, sf_dir, "spec_books").where(F.col("book").isNotNull()).groupBy("book").agg(F.min("start_file").alias("start_file"), F.min("start_block").alias("start_block"), F.min("exact").alias("exact"))
    return resolve.resolve(asked, blocks, books)


QUERIES = {"p4_found": p4_found, "p4_entries_table": p4_entries_table, "p4_entry_values": p4_entry_values, "p4_entry_fields": p4_entry_fields, "p4_spec_groups": p4_spec_groups, "p4_content_groups": p4_content_groups, "p4_group_sizes": p4_group_sizes, "markdown_rich": markdown_rich, "markdown_render": markdown_render, "markdown_parts": markdown_parts, "resolve_search_spec": resolve_search_spec}
#: Nested texts are read by a recursive query, so that the tree walk is the SQL engine's own.
SQL = {
    "p4_found": """WITH RECURSIVE texts AS (SELECT record_id AS id, '' AS prefix, ltrim(body, chr(65279)) AS j FROM (SELECT DISTINCT record_id, body FROM spec_records) WHERE json_valid(ltrim(body, chr(65279)))
UNION ALL SELECT texts.id, ltrim(texts.prefix || substr(t.fullkey, 2), '.'), t.atom ->> '$' FROM texts, json_tree(texts.j) t WHERE t.key = 'children' AND t.type = 'VARCHAR' AND json_valid(t.atom ->> '$')),
nodes AS (SELECT DISTINCT 'spec' AS src, texts.id AS rec_id, ltrim(prefix || substr(t.path, 2), '.') AS node_path FROM texts, json_tree(texts.j) t WHERE t.key = 'label'
UNION ALL SELECT DISTINCT 'content', block_id, substr(t.path, 3) FROM (SELECT DISTINCT block_id, item FROM content_blocks WHERE json_valid(item)) c, json_tree(c.item) t WHERE t.key = 'type' AND (t.path = '$.content' OR starts_with(t.path, '$.content.') OR starts_with(t.path, '$.content['))),
links AS (SELECT n.*, p.node_path AS above, row_number() OVER (PARTITION BY n.src, n.rec_id, n.node_path ORDER BY length(p.node_path) DESC NULLS LAST) AS k FROM nodes n LEFT JOIN nodes p ON p.src = n.src AND p.rec_id = n.rec_id AND (p.node_path = '' AND n.node_path <> '' OR starts_with(n.node_path, p.node_path || '.') OR starts_with(n.node_path, p.node_path || '[')))
SELECT src, rec_id, node_path, coalesce(above, '') AS parent_path FROM links WHERE k = 1""",
    "p4_entry_fields": """WITH RECURSIVE texts AS (SELECT record_id AS id, '' AS prefix, ltrim(body, chr(65279)) AS j FROM (SELECT DISTINCT record_id, body FROM spec_records) WHERE json_valid(ltrim(body, chr(65279)))
UNION ALL SELECT texts.id, ltrim(texts.prefix || substr(t.fullkey, 2), '.'), t.atom ->> '$' FROM texts, json_tree(texts.j) t WHERE t.key = 'children' AND t.type = 'VARCHAR' AND json_valid(t.atom ->> '$')),
fields AS (SELECT texts.id AS rec_id, ltrim(prefix || substr(t.path, 2), '.') AS node_path, t.key AS k, t.atom ->> '$' AS v FROM texts, json_tree(texts.j) t WHERE t.key IN ('label', 'file', 'block', 'expect', 'printed', 'occurrence'))
SELECT rec_id, node_path, max(v) FILTER (k = 'label') AS label, max(v) FILTER (k = 'file') AS file, max(v) FILTER (k = 'block') AS block, max(v) FILTER (k = 'expect') AS expect, max(v) FILTER (k = 'printed') AS printed, max(v) FILTER (k = 'occurrence') AS occurrence FROM fields GROUP BY rec_id, node_path HAVING count(*) FILTER (k = 'label') > 0""",
}
