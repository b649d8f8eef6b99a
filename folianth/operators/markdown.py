"""Markdown lines to blocks to HTML.

Fences dominate lists, lists dominate paragraphs. All state is told by windows over the lines of one document: whether a line
stands inside a fence (parity of fence marks before it), and which paragraph or list it belongs to (breaks counted so far).
A document is one text, so its lines are bounded by that text and are never spread over documents.

Null texts have no lines; the empty text has one blank line and no block; an open fence ends with the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folianth.functions import classify, rules

HEADING = r"^(#{1,6})[ \t]+(.*)$"
IMAGE = r"^!\[([^\]]*)\]\(([^)]*)\)$"
RAW_HTML = r"(?i)^</?(?:table|thead|tbody|tfoot|tr|td|th|colgroup|col|caption|div|span|p|br)(?:[^0-9A-Za-z_]|$)"


def escaped(text: Column) -> Column:
    """HTML escape, `&` first; quotes too."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def kinds(lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, kind): fence, code, blank, html, heading, image, item, quote, meta or text."""
    bare = rules.apply("artifact_prefix", F.col("line"))
    rows = lines.select("doc_id", "line_no", "line", bare.alias("bare"))
    order = Window.partitionBy("doc_id").orderBy("line_no")
    fence = F.col("bare").startswith("```") & ~F.col("bare").startswith("% ")
    rows = rows.withColumn("fence", fence).withColumn("open", F.sum(F.col("fence").cast("int")).over(order) % 2 == 1)
    b = F.col("bare")
    kind = (
        F.when(b.startswith("% "), "meta").when(F.col("fence"), "fence").when(F.col("open"), "code").when(b == "", "blank").when(b.rlike(RAW_HTML), "html").when(b.rlike(HEADING), "heading")
        .when(b.rlike(IMAGE), "image").when(b.startswith("- "), "item").when(b.startswith("> "), "quote").otherwise("text")
    )
    return rows.select("doc_id", "line_no", "line", "bare", kind.alias("kind"))


def blocks(lines: DataFrame) -> DataFrame:
    """(doc_id, block_no, tag, text): the blocks of each document in order; tags h1-h3, p, strong, li, figure, blockquote, pre, html.

    Heading levels are shifted so that the highest of the document is h1, at most h3; a heading that is a printed contents entry
    or the word for contents becomes a bold paragraph; where a document has no heading at all, chapter lines are headings.
    """
    rows = kinds(lines)
    order = Window.partitionBy("doc_id").orderBy("line_no")
    whole = Window.partitionBy("doc_id")
    head = rules.apply(rules.STRIP, F.regexp_extract("bare", HEADING, 2))
    marks = F.length(F.regexp_extract("bare", HEADING, 1))
    rows = rows.withColumn("least", F.min(F.when((F.col("kind") == "heading") & (head != "目录"), marks)).over(whole))
    fallback = F.col("least").isNull() & (F.col("kind") == "text") & classify.fallback_heading(F.col("bare"))
    rows = rows.withColumn("kind", F.when(fallback, "chapter").otherwise(F.col("kind")))
    # paragraphs and code blocks are runs; every other line is a block of its own
    rows = rows.where(~F.col("kind").isin("meta", "blank") | (F.col("kind") == "blank"))
    same = F.col("kind").isin("text", "code") & (F.col("kind") == F.lag("kind").over(order))
    rows = rows.withColumn("run", F.sum(F.when(same, 0).otherwise(1)).over(order)).where(~F.col("kind").isin("blank", "fence"))
    level = F.when(F.col("least").isNull(), marks).otherwise(F.greatest(F.lit(1), F.least(F.lit(3), marks - F.col("least") + 1)))
    bold = (head == "目录") | classify.printed_entry(head)
    tag = (
        F.when((F.col("kind") == "heading") & bold, "strong").when(F.col("kind") == "heading", F.concat(F.lit("h"), level)).when(F.col("kind") == "chapter", "h1").when(F.col("kind") == "item", "li")
        .when(F.col("kind") == "quote", "blockquote").when(F.col("kind") == "image", "figure").when(F.col("kind") == "code", "pre").when(F.col("kind") == "html", "html").otherwise("p")
    )
    text = F.when(F.col("kind") == "heading", head).when(F.col("kind").isin("item", "quote"), rules.apply(rules.STRIP, F.substring("bare", 3, 1_000_000_000))).when(F.col("kind") == "code", F.col("line")).otherwise(F.col("bare"))
    rows = rows.select("doc_id", "run", "line_no", tag.alias("tag"), text.alias("text"))
    out = rows.groupBy("doc_id", "run").agg(F.min("line_no").alias("line_no"), F.min("tag").alias("tag"), F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("parts"))
    joined = F.call_function("array_join", F.transform("parts", lambda x: x["text"]), F.when(F.col("tag") == "pre", "\n").otherwise(" "))
    kept = out.select("doc_id", "line_no", "tag", joined.alias("text")).where((F.col("tag") != "figure") | classify.image_path(F.regexp_extract("text", IMAGE, 2)))
    return kept.select("doc_id", F.row_number().over(order).cast("bigint").alias("block_no"), "tag", "text")


def html(block_rows: DataFrame) -> DataFrame:
    """(doc_id, html): the body of each document; neighbouring items share one list."""
    order = Window.partitionBy("doc_id").orderBy("block_no")
    t, text = F.col("tag"), F.col("text")
    opens = (t == "li") & ~F.coalesce(F.lag("tag").over(order) == "li", F.lit(False))
    closes = (t == "li") & ~F.coalesce(F.lead("tag").over(order) == "li", F.lit(False))
    strong = F.regexp_replace(escaped(text), r"\*\*([^*]+)\*\*", "<strong>$1</strong>")
    body = (
        F.when(t == "p", F.concat(F.lit("<p>"), strong, F.lit("</p>"))).when(t == "strong", F.concat(F.lit("<p><strong>"), escaped(text), F.lit("</strong></p>"))).when(t == "pre", F.concat(F.lit("<pre><code>"), escaped(text), F.lit("</code></pre>"))).when(t == "html", text)
        .when(t == "figure", F.concat(F.lit('<figure><img src="'), escaped(F.regexp_extract("text", IMAGE, 2)), F.lit('" alt="'), escaped(F.regexp_extract("text", IMAGE, 1)), F.lit('"></figure>')))
        .otherwise(F.concat(F.lit("<"), t, F.lit(">"), escaped(text), F.lit("</"), t, F.lit(">")))
    )
    rows = block_rows.select("doc_id", "block_no", F.concat(F.when(opens, "<ul>\n").otherwise(""), body, F.when(closes, "\n</ul>").otherwise("")).alias("part"))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "part"))), lambda x: x["part"]), "\n").alias("html"))
