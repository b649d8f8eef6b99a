"""The relations that the queries share, as DataFrames and as SQL.

Rows delivered again are counted once by their key. A document stands for a chapter file; its lines are the blocks of its Markdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folianth.functions.rules import quoted
from folianth.sources.tables import table

LINES_SQL = "lines AS (SELECT doc_id, book, unnest(range(len(s))) AS line_no, unnest(s) AS line FROM (SELECT doc_id, book, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL))"
ENTRIES_SQL = "entries AS (SELECT entry_id, any_value(book) AS book, any_value(seq) AS seq, any_value(parent_seq) AS parent_seq, any_value(path) AS path, any_value(label) AS label, any_value(file) AS file, any_value(block) AS block, any_value(deviation) AS deviation, any_value(printed) AS printed, any_value(expect) AS expect FROM spec_entries GROUP BY entry_id)"
TITLES_SQL = f"{LINES_SQL}, {ENTRIES_SQL}, titles AS (SELECT 'printed' AS src, book AS owner, CAST(line_no AS BIGINT) AS n, line AS title FROM printed_lines UNION ALL SELECT 'label', book, entry_id, label FROM entries UNION ALL SELECT 'line', CAST(doc_id AS VARCHAR), CAST(line_no AS BIGINT), line FROM lines)"


def lines(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """(doc_id, book, line_no, line) of every document's text.

    `together` is for windows over documents: the texts are shuffled before they are cut, which moves fewer and smaller rows
    than their lines would be, and the windows find their rows in place.
    """
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select("doc_id", "book", "text")
    if together:
        docs = docs.repartition("doc_id")
    return docs.select("doc_id", "book", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).select("doc_id", "book", F.col("line_no").cast("bigint").alias("line_no"), "line")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviewed navigation entries, each once."""
    return table(spark, sf_dir, "spec_entries").dropDuplicates(["entry_id"]).drop("received_at")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, owner, n, title): printed lines, labels and document lines under one form."""
    printed = table(spark, sf_dir, "printed_lines").select(F.lit("printed").alias("src"), F.col("book").alias("owner"), F.col("line_no").cast("bigint").alias("n"), F.col("line").alias("title"))
    labels = entries(spark, sf_dir).select(F.lit("label").alias("src"), F.col("book").alias("owner"), F.col("entry_id").alias("n"), F.col("label").alias("title"))
    text = lines(spark, sf_dir).select(F.lit("line").alias("src"), F.col("doc_id").cast("string").alias("owner"), F.col("line_no").alias("n"), F.col("line").alias("title"))
    return printed.unionByName(labels).unionByName(text)


#: Entries of an invented book with what the tables have none of: a place before the one listed above it, a place taken twice, a gap in the
#: numbers, no place, a label that stands again in a later chapter.
CASE_ENTRIES = [
    (-1, "case-a", 1, "Opening of the mill", "text/split_001.html", 4), (-2, "case-a", 2, "The lower weir", "text/split_001.html", 2), (-3, "case-a", 4, "The weir, again", "text/split_001.html", 2), (-4, "case-a", 5, "Lost leaf", None, None),
    (-5, "case-a", 6, "Lanterns of the quay", "text/split_002.html", 0), (-6, "case-b", 1, "Only entry", "text/split_001.html", 0), (-7, "case-b", 2, None, "text/split_003.html", 1),
]
#: Chapters of that book: a repeated heading, headings that are printed contents lines, the label in a later chapter.
CASE_DOCS = [
    (-1, "case-a", 1, "# Ropes\n\nOpening of the mill, at last.\n\n# Ropes\n\nMore of it.\n\n# 第三章 涨潮……12"), (-2, "case-a", 2, "## Quay\n\nNothing here."), (-3, "case-a", 3, "The lanterns of the quay: Lanterns of the quay.\n\n### 附录 .... 7"),
    (-4, "case-b", 2, "Only entry stands here.\nOnly entry stands here."), (-5, None, 1, None),
]


def _rows(rows: list[tuple]) -> str:
    one = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v).lower() if isinstance(v, bool) else quoted(v)
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


def values_sql(columns: str, rows: list[tuple]) -> str:
    """`columns` as `name TYPE, ...`: a SELECT of literal rows for the SQL engine."""
    names = [c.split()[0] for c in columns.split(", ")]
    casts = ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in columns.split(", "))
    if not rows:
        return f"SELECT {casts.replace('CAST(', 'CAST(')} FROM (SELECT {', '.join(f'NULL AS {n}' for n in names)}) WHERE false"
    return f"SELECT {casts} FROM (VALUES {_rows(rows)}) t({', '.join(names)})"


def literal(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """Literal rows as a table of one partition."""
    return spark.createDataFrame(rows, schema).coalesce(1)


CASE_ENTRY_SCHEMA = "entry_id bigint, book string, seq bigint, label string, file string, block int"
CASE_ENTRIES_SQL = "SELECT entry_id, book, seq, label, file, block, TRY_CAST(nullif(regexp_extract(file, '([0-9]+)', 1), '') AS BIGINT) * 1000000000 + block AS pos FROM (" + values_sql("entry_id BIGINT, book VARCHAR, seq BIGINT, label VARCHAR, file VARCHAR, block INTEGER", CASE_ENTRIES) + ")"
CASE_DOCS_SQL = values_sql("doc_id BIGINT, book VARCHAR, chapter_no INTEGER, text VARCHAR", CASE_DOCS)
