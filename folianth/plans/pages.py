"""Queries on converted chapters: blocks, quality audits, context frames, Markdown to HTML."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folianth.functions import classify, rules
from folianth.functions.rules import as_sql, quoted
from folianth.operators import markdown as M
from folianth.operators import ordered
from folianth.plans.relations import CASE_DOCS, CASE_DOCS_SQL, LINES_SQL, lines, literal
from folianth.sources.tables import table


def _case_lines(spark):
    docs = literal(spark, "doc_id bigint, book string, chapter_no int, text string", CASE_DOCS)
    return docs.where("text IS NOT NULL").select("doc_id", "book", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).select("doc_id", "book", F.col("line_no").cast("bigint").alias("line_no"), "line")


def blocks(spark, d):
    return M.blocks(lines(spark, d, together=True))


def markdown_line_kinds(spark, d):
    return M.kinds(lines(spark, d, together=True)).groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def markdown_to_html(spark, d):
    return M.html(blocks(spark, d))


def block_tag_counts(spark, d):
    return blocks(spark, d).groupBy("tag").agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.length("text")).alias("chars"))


def page_quality_audit(spark, d):
    """Figures of every chapter: blocks, headings, list items, images, characters."""
    return blocks(spark, d).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("tag").rlike("^h[1-6]$")).alias("headings"), F.count_if(F.col("tag") == "li").alias("items"), F.count_if(F.col("tag") == "figure").alias("images"),
        F.coalesce(F.sum(F.when(F.col("tag") != "figure", F.length("text"))), F.lit(0)).alias("chars"),
    )


def heading_stats(spark, d):
    h = blocks(spark, d).where(F.col("tag").rlike("^h[1-6]$"))
    return h.groupBy("doc_id").agg(F.count(F.lit(1)).alias("headings"), F.count_distinct("text").alias("distinct_headings"), F.max(F.length("text")).cast("bigint").alias("longest"))


def duplicate_headings(spark, d):
    """Headings that come again in their document; with the chapters of the case book."""
    h = M.blocks(lines(spark, d, together=True).unionByName(_case_lines(spark))).where(F.col("tag").rlike("^h[1-6]$"))
    return h.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def smallest_pages_topk(spark, d):
    """The twelve chapters with the fewest characters."""
    return page_quality_audit(spark, d).orderBy("chars", "doc_id").limit(12).select("doc_id", "chars", "blocks")


def structural_hits(spark, d):
    """Headings and chapter lines with one block before and two after."""
    order = Window.partitionBy("doc_id").orderBy("block_no")
    rows = blocks(spark, d).withColumn("context", F.substring(F.array_join(F.collect_list("text").over(order.rowsBetween(-1, 2)), " | "), 1, 1000))
    t = F.col("text")
    hit = F.col("tag").rlike("^h[1-6]$") | (t.rlike(classify.STRUCTURE) & (F.length(t) <= 180)) | t.isin(classify.FRONT_WORDS)
    return rows.where(hit & ~t.rlike(classify.PAGE_ONLY)).select("doc_id", "block_no", "tag", "text", "context")


def context_window(spark, d):
    """Each heading with two blocks before and four after."""
    order = Window.partitionBy("doc_id").orderBy("block_no")
    rows = blocks(spark, d).withColumn("context", F.substring(F.array_join(F.collect_list("text").over(order.rowsBetween(-2, 4)), " | "), 1, 1000))
    return rows.where(F.col("tag").rlike("^h[1-6]$")).select("doc_id", "block_no", "context")


def _prose():
    return (F.length("line") > 260) & ~F.col("line").rlike(classify.PAGE_SUFFIX) & ~F.substring("line", 1, 80).rlike(classify.STRUCTURE)


def toc_windows(spark, d):
    """From each short block with a word for contents: which blocks belong to the printed contents, and their text (eight windows a document).

    A window ends after 500 blocks, with the document, or before the first run of three prose blocks that ends at its twelfth block or later.
    """
    order = Window.partitionBy("doc_id").orderBy("block_no")
    before = lambda n: F.coalesce(F.lag("prose", n).over(order), F.lit(False))
    t = F.col("text")
    prose = (F.length(t) > 260) & ~t.rlike(classify.PAGE_SUFFIX) & ~F.substring(t, 1, 80).rlike(classify.STRUCTURE)
    rows = blocks(spark, d).withColumn("prose", prose).withColumn("third", F.col("prose") & before(1) & before(2))
    # the nearest end of a run from the twelfth block on, told by a window that looks forward: no pairs of hits and stops
    stop = F.min(F.when(F.col("third"), F.col("block_no"))).over(order.rowsBetween(11, 499))
    rows = rows.withColumns({"stop": stop, "size": F.least(F.lit(500), F.count(F.lit(1)).over(order.rowsBetween(0, Window.unboundedFollowing)))})
    hits = rows.where(t.rlike(classify.TOC_WORD) & (F.length(t) <= 80)).withColumn("k", F.row_number().over(order)).where("k <= 8")
    spans = hits.select("doc_id", F.col("block_no").alias("start"), F.coalesce(F.col("stop") - F.col("block_no") - 2, F.col("size")).alias("n_blocks"))
    # a window is at most 500 blocks, so the blocks it takes are named one by one and met by number
    taken = spans.select("doc_id", "start", "n_blocks", F.explode(F.sequence(F.col("start"), F.col("start") + F.greatest(F.col("n_blocks"), F.lit(1)) - 1)).alias("block_no")).join(rows.select("doc_id", "block_no", "tag", "text"), ["doc_id", "block_no"])
    line = F.concat(F.lit("["), F.col("block_no"), F.lit(":"), F.col("tag"), F.lit("] "), F.col("text"))
    return taken.groupBy("doc_id", "start", "n_blocks").agg(F.substring(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", line.alias("line")))), lambda x: x["line"]), "\n"), 1, 30000).alias("text"))


WINDOW_LINES = 3


def window_concat(spark, d):
    """Keys of each block with the two after it, and with the one after it: titles that wrap."""
    order = Window.partitionBy("doc_id").orderBy("line_no")
    rows = lines(spark, d, together=True).withColumns({f"t{k}": F.lead("line", k).over(order) for k in range(1, WINDOW_LINES)})
    out = None
    for size in range(2, WINDOW_LINES + 1):
        some = rows.where(F.col(f"t{size - 1}").isNotNull()).select("doc_id", "line_no", F.lit(size).alias("size"), rules.apply("key_resolve", F.concat_ws(" ", "line", *(f"t{k}" for k in range(1, size)))).alias("key"))
        out = some if out is None else out.unionByName(some)
    return out.where(F.length("key") > 0).select("doc_id", "line_no", "size", F.sha2("key", 256).alias("key"))


def nth_occurrence(spark, d):
    """The second place after the first heading (the cursor) of every line that comes again in its document; with the chapters of the case book."""
    whole = Window.partitionBy("doc_id")
    rows = lines(spark, d, together=True).unionByName(_case_lines(spark)).withColumn("cursor", F.coalesce(F.min(F.when(F.col("line").startswith("#"), F.col("line_no"))).over(whole), F.lit(-1))).where(F.col("line_no") > F.col("cursor"))
    order = Window.partitionBy("doc_id", "line").orderBy("line_no")
    return rows.where(F.length("line") > 0).withColumn("k", F.row_number().over(order)).where("k = 2").select("doc_id", "line", "line_no")


def cumulative_shift(spark, d):
    """How many headings stand before each image: what insertions before it would shift."""
    order = Window.partitionBy("doc_id").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = blocks(spark, d).withColumn("shift", F.coalesce(F.sum(F.col("tag").rlike("^h[1-6]$").cast("bigint")).over(order), F.lit(0)))
    return rows.where(F.col("tag") == "figure").select("doc_id", "block_no", "shift")


def broken_image_refs(spark, d):
    """Images of chapters whose path no layout item holds."""
    refs = blocks(spark, d).where(F.col("tag") == "figure").select("doc_id", F.regexp_extract("text", M.IMAGE, 2).alias("path"))
    item = F.col("item")
    held = table(spark, d, "content_blocks").select(F.coalesce(F.get_json_object(item, "$.img_path"), F.get_json_object(item, "$.content.image_source.path")).alias("path")).where(F.col("path").isNotNull()).distinct()
    return refs.join(held, "path", "left_anti").groupBy("doc_id").agg(F.count(F.lit(1)).alias("broken"))


def body_heading_candidates(spark, d):
    """Up to 120 headings and chapter lines of a document, headings first."""
    b = blocks(spark, d).where(F.length("text") <= 90)
    rank = F.when(F.col("tag").rlike("^h[1-6]$"), 0).when(F.col("text").rlike(classify.STRUCTURE), 1)
    rows = b.withColumn("rank", rank).where(F.col("rank").isNotNull()).withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("rank", "block_no")))
    return rows.where("k <= 120").select("doc_id", "rank", "block_no", "text")


def demote_headings(spark, d):
    """Headings that are lines of a printed contents list, as the paragraphs they become; with the chapters of the case book."""
    b = lines(spark, d).unionByName(_case_lines(spark)).where(F.col("line").rlike(M.HEADING)).select("doc_id", "line_no", rules.apply(rules.STRIP, F.regexp_extract("line", M.HEADING, 2)).alias("text"))
    return b.where(classify.printed_entry(F.col("text"))).select("doc_id", "line_no", F.concat(F.lit("**"), F.col("text"), F.lit("**")).alias("text"))


def layout_type_histogram(spark, d):
    """Types of layout items by source, as one sorted text."""
    n = table(spark, d, "content_blocks").dropDuplicates(["block_id"]).groupBy("source", "type").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("source").agg(F.sum("n").alias("items"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "type", F.col("n").cast("string")))), ",").alias("types"))


def inventory_hash(spark, d):
    """SHA-256 of every document's text."""
    return table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.sha2("text", 256).alias("sha256"))


def inventory_copies(spark, d):
    """Texts that stand under several ids."""
    return inventory_hash(spark, d).groupBy("sha256").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


def source_pick(spark, d):
    """For each book the delivery to convert: layout items with nested content before flat ones (the tier), then the largest, ties by name."""
    rows = table(spark, d, "content_blocks").where("book IS NOT NULL AND source IS NOT NULL").dropDuplicates(["block_id"])
    n = rows.groupBy("book", "source").agg(F.min(F.when(F.col("item").contains('"content"'), 0).otherwise(1)).alias("tier"), F.coalesce(F.sum(F.length("item")), F.lit(0)).alias("size"))
    best = F.struct("tier", -F.col("size"), "source")
    return n.groupBy("book").agg(F.min_by("source", best).alias("source"), F.min("tier").alias("tier"), F.min_by("size", best).alias("size"))


def job_order(spark, d, limit=None):
    """All books, the smallest first, then by name; only the first `limit` if the caller gives one."""
    n = table(spark, d, "content_blocks").where("book IS NOT NULL").dropDuplicates(["block_id"]).groupBy("book").agg(F.sum(F.length("item")).alias("size"))
    jobs = n.orderBy("size", "book")
    return jobs.limit(limit) if limit else jobs


def job_ranks(spark, d):
    """Every book with its rank in the order of jobs, from 1."""
    return ordered.numbered(job_order(spark, d), [], ["size", "book"], F.floor(F.col("size") / ordered.BUCKET), "rank")


_ART, _STRIPPED = as_sql("artifact_prefix", "line"), lambda x: as_sql(rules.STRIP, x)
_H, _I, _R = quoted(M.HEADING), quoted(M.IMAGE), quoted(M.RAW_HTML)
_KINDS = f"""{LINES_SQL}, a AS (SELECT doc_id, line_no, line, {_ART} AS bare FROM lines), o AS (SELECT *, sum(CASE WHEN starts_with(bare, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) % 2 = 1 AS open FROM a),
kinds AS (SELECT *, CASE WHEN starts_with(bare, '% ') THEN 'meta' WHEN starts_with(bare, '```') THEN 'fence' WHEN open THEN 'code' WHEN bare = '' THEN 'blank' WHEN regexp_matches(bare, {_R}) THEN 'html' WHEN regexp_matches(bare, {_H}) THEN 'heading' WHEN regexp_matches(bare, {_I}) THEN 'image' WHEN starts_with(bare, '- ') THEN 'item' WHEN starts_with(bare, '> ') THEN 'quote' ELSE 'text' END AS kind FROM o)"""
_HEAD = _STRIPPED(f"regexp_extract(bare, {_H}, 2)")
_BLOCKS = f"""{_KINDS}, h AS (SELECT *, {_HEAD} AS head, length(regexp_extract(bare, {_H}, 1)) AS marks FROM kinds), l AS (SELECT *, min(CASE WHEN kind = 'heading' AND head <> '目录' THEN marks END) OVER (PARTITION BY doc_id) AS least FROM h),
c AS (SELECT * REPLACE (CASE WHEN least IS NULL AND kind = 'text' AND {classify.fallback_heading.sql('bare')} THEN 'chapter' ELSE kind END AS kind) FROM l), g AS (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM c WHERE kind <> 'meta'),
r AS (SELECT *, sum(CASE WHEN kind IN ('text', 'code') AND kind = before THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM g),
t AS (SELECT doc_id, run, line_no, CASE WHEN kind = 'heading' AND (head = '目录' OR {classify.printed_entry.sql('head')}) THEN 'strong' WHEN kind = 'heading' THEN 'h' || CASE WHEN least IS NULL THEN marks ELSE greatest(1, least(3, marks - least + 1)) END WHEN kind = 'chapter' THEN 'h1' WHEN kind = 'item' THEN 'li' WHEN kind = 'quote' THEN 'blockquote' WHEN kind = 'image' THEN 'figure' WHEN kind = 'code' THEN 'pre' WHEN kind = 'html' THEN 'html' ELSE 'p' END AS tag,
CASE WHEN kind = 'heading' THEN head WHEN kind IN ('item', 'quote') THEN {_STRIPPED('substring(bare, 3)')} WHEN kind = 'code' THEN line ELSE bare END AS text FROM r WHERE kind NOT IN ('blank', 'fence')),
j AS (SELECT doc_id, min(line_no) AS line_no, min(tag) AS tag, CASE WHEN min(tag) = 'pre' THEN string_agg(text, chr(10) ORDER BY line_no) ELSE string_agg(text, ' ' ORDER BY line_no) END AS text FROM t GROUP BY doc_id, run),
blocks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS block_no, tag, text FROM j WHERE tag <> 'figure' OR {classify.image_path.sql(f'regexp_extract(text, {_I}, 2)')})"""
_ESC = lambda x: f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_ISH = "regexp_matches(tag, '^h[1-6]$')"
_AUDIT = f"{_BLOCKS}, audit AS (SELECT doc_id, count(*) AS blocks, count(*) FILTER ({_ISH}) AS headings, count(*) FILTER (tag = 'li') AS items, count(*) FILTER (tag = 'figure') AS images, CAST(coalesce(sum(length(text)) FILTER (tag <> 'figure'), 0) AS BIGINT) AS chars FROM blocks GROUP BY doc_id)"
_CONTEXT = lambda a, b: f"substring(array_to_string(list(text) OVER (PARTITION BY doc_id ORDER BY block_no ROWS BETWEEN {a} PRECEDING AND {b} FOLLOWING), ' | '), 1, 1000) AS context"
_ONCE = "(SELECT block_id, any_value(book) AS book, any_value(source) AS source, any_value(type) AS type, any_value(item) AS item FROM content_blocks GROUP BY block_id)"
_PROSE = f"(length(text) > 260 AND NOT regexp_matches(text, {quoted(classify.PAGE_SUFFIX)}) AND NOT regexp_matches(substring(text, 1, 80), {quoted(classify.STRUCTURE)}))"
_CASE_LINES = f"case_lines AS (SELECT doc_id, book, unnest(range(len(s))) AS line_no, unnest(s) AS line FROM (SELECT doc_id, book, string_split(text, chr(10)) AS s FROM ({CASE_DOCS_SQL}) WHERE text IS NOT NULL))"
_BOTH_LINES = LINES_SQL.replace("lines AS (", "table_lines AS (", 1) + f", {_CASE_LINES}, lines AS (SELECT * FROM table_lines UNION ALL SELECT * FROM case_lines)"

SQL = {
    "markdown_blocks": f"WITH {_BLOCKS} SELECT * FROM blocks",
    "markdown_line_kinds": f"WITH {_KINDS} SELECT doc_id, kind, count(*) AS n FROM kinds GROUP BY doc_id, kind",
    "markdown_to_html": f"""WITH {_BLOCKS}, n AS (SELECT *, lag(tag) OVER (PARTITION BY doc_id ORDER BY block_no) AS b, lead(tag) OVER (PARTITION BY doc_id ORDER BY block_no) AS f FROM blocks) SELECT doc_id, string_agg(CASE WHEN tag = 'li' AND b IS DISTINCT FROM 'li' THEN '<ul>' || chr(10) ELSE '' END || CASE WHEN tag = 'p' THEN '<p>' || regexp_replace({_ESC('text')}, '\\*\\*([^*]+)\\*\\*', '<strong>\\1</strong>', 'g') || '</p>' WHEN tag = 'strong' THEN '<p><strong>' || {_ESC('text')} || '</strong></p>' WHEN tag = 'pre' THEN '<pre><code>' || {_ESC('text')} || '</code></pre>' WHEN tag = 'html' THEN text WHEN tag = 'figure' THEN '<figure><img src="' || {_ESC(f'regexp_extract(text, {_I}, 2)')} || '" alt="' || {_ESC(f'regexp_extract(text, {_I}, 1)')} || '"></figure>' ELSE '<' || tag || '>' || {_ESC('text')} || '</' || tag || '>' END || CASE WHEN tag = 'li' AND f IS DISTINCT FROM 'li' THEN chr(10) || '</ul>' ELSE '' END, chr(10) ORDER BY block_no) AS html FROM n GROUP BY doc_id""",
    "block_tag_counts": f"WITH {_BLOCKS} SELECT tag, count(*) AS blocks, CAST(sum(length(text)) AS BIGINT) AS chars FROM blocks GROUP BY tag",
    "page_quality_audit": f"WITH {_AUDIT} SELECT * FROM audit",
    "heading_stats": f"WITH {_BLOCKS} SELECT doc_id, count(*) AS headings, count(DISTINCT text) AS distinct_headings, max(length(text)) AS longest FROM blocks WHERE {_ISH} GROUP BY doc_id",
    "duplicate_headings": f"WITH {_BLOCKS.replace(LINES_SQL, _BOTH_LINES)} SELECT doc_id, text, count(*) AS n FROM blocks WHERE {_ISH} GROUP BY doc_id, text HAVING count(*) > 1",
    "smallest_pages_topk": f"WITH {_AUDIT} SELECT doc_id, chars, blocks FROM audit ORDER BY chars, doc_id LIMIT 12",
    "structural_hits": f"WITH {_BLOCKS}, w AS (SELECT *, {_CONTEXT(1, 2)} FROM blocks) SELECT doc_id, block_no, tag, text, context FROM w WHERE ({_ISH} OR (regexp_matches(text, {quoted(classify.STRUCTURE)}) AND length(text) <= 180) OR text IN ({', '.join(map(quoted, classify.FRONT_WORDS))})) AND NOT regexp_matches(text, {quoted(classify.PAGE_ONLY)})",
    "context_window": f"WITH {_BLOCKS}, w AS (SELECT *, {_CONTEXT(2, 4)} FROM blocks) SELECT doc_id, block_no, context FROM w WHERE {_ISH}",
    "toc_windows": f"""WITH {_BLOCKS}, tp AS (SELECT *, {_PROSE} AS prose, max(block_no) OVER (PARTITION BY doc_id) AS total FROM blocks), tq AS (SELECT *, prose AND coalesce(lag(prose, 1) OVER tw, false) AND coalesce(lag(prose, 2) OVER tw, false) AS third FROM tp WINDOW tw AS (PARTITION BY doc_id ORDER BY block_no)),
    th AS (SELECT doc_id, block_no AS start, total, row_number() OVER (PARTITION BY doc_id ORDER BY block_no) AS k FROM tq WHERE regexp_matches(text, {quoted(classify.TOC_WORD)}) AND length(text) <= 80),
    ts AS (SELECT doc_id, start, coalesce((SELECT min(block_no) FROM tq WHERE tq.doc_id = th.doc_id AND third AND block_no >= start + 11 AND block_no < start + 500) - start - 2, least(500, total - start + 1)) AS n_blocks FROM th WHERE k <= 8)
    SELECT ts.doc_id, start, n_blocks, substring(string_agg('[' || block_no || ':' || tag || '] ' || text, chr(10) ORDER BY block_no), 1, 30000) AS text FROM ts JOIN blocks b ON b.doc_id = ts.doc_id AND block_no BETWEEN start AND start + greatest(n_blocks, 1) - 1 GROUP BY ts.doc_id, start, n_blocks""",
    "window_concat": f"WITH {LINES_SQL}, n AS (SELECT *, lead(line, 1) OVER w AS a, lead(line, 2) OVER w AS b FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)), k AS (SELECT doc_id, line_no, 2 AS size, {as_sql('key_resolve', chr(40) + 'line || chr(32) || a' + chr(41))} AS key FROM n WHERE a IS NOT NULL UNION ALL SELECT doc_id, line_no, 3, {as_sql('key_resolve', chr(40) + 'line || chr(32) || a || chr(32) || b' + chr(41))} FROM n WHERE b IS NOT NULL) SELECT doc_id, line_no, size, sha256(key) AS key FROM k WHERE length(key) > 0",
    "nth_occurrence": f"WITH {_BOTH_LINES}, c AS (SELECT doc_id, min(line_no) AS cursor FROM lines WHERE starts_with(line, '#') GROUP BY doc_id), n AS (SELECT l.*, row_number() OVER (PARTITION BY l.doc_id, line ORDER BY line_no) AS k FROM lines l LEFT JOIN c ON c.doc_id = l.doc_id WHERE length(line) > 0 AND line_no > coalesce(cursor, -1)) SELECT doc_id, line, line_no FROM n WHERE k = 2",
    "cumulative_shift": f"WITH {_BLOCKS}, s AS (SELECT *, CAST(coalesce(sum(CASE WHEN {_ISH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS shift FROM blocks) SELECT doc_id, block_no, shift FROM s WHERE tag = 'figure'",
    "broken_image_refs": f"WITH {_BLOCKS}, held AS (SELECT DISTINCT coalesce(json_extract_string(item, '$.img_path'), json_extract_string(item, '$.content.image_source.path')) AS path FROM content_blocks WHERE json_valid(item)) SELECT doc_id, count(*) AS broken FROM (SELECT doc_id, regexp_extract(text, {_I}, 2) AS path FROM blocks WHERE tag = 'figure') r WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.path = r.path) GROUP BY doc_id",
    "body_heading_candidates": f"WITH {_BLOCKS}, k AS (SELECT *, CASE WHEN {_ISH} THEN 0 WHEN regexp_matches(text, {quoted(classify.STRUCTURE)}) THEN 1 END AS rank FROM blocks WHERE length(text) <= 90), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rank, block_no) AS no FROM k WHERE rank IS NOT NULL) SELECT doc_id, rank, block_no, text FROM n WHERE no <= 120",
    "demote_headings": f"WITH {_BOTH_LINES}, b AS (SELECT doc_id, line_no, {_STRIPPED(f'regexp_extract(line, {_H}, 2)')} AS text FROM lines WHERE regexp_matches(line, {_H})) SELECT doc_id, line_no, '**' || text || '**' AS text FROM b WHERE {classify.printed_entry.sql('text')}",
    "layout_type_histogram": f"SELECT source, CAST(sum(n) AS BIGINT) AS items, string_agg(type || ':' || n, ',' ORDER BY type || ':' || n) AS types FROM (SELECT source, type, count(*) AS n FROM {_ONCE} GROUP BY source, type) GROUP BY source",
    "inventory_hash": "SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL",
    "inventory_copies": "SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "source_pick": f"SELECT book, source, tier, size FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY tier, size DESC, source) AS k FROM (SELECT book, source, min(CASE WHEN contains(item, '\"content\"') THEN 0 ELSE 1 END) AS tier, CAST(coalesce(sum(length(item)), 0) AS BIGINT) AS size FROM {_ONCE} WHERE book IS NOT NULL AND source IS NOT NULL GROUP BY book, source)) WHERE k = 1",
    "job_order": f"SELECT book, CAST(sum(length(item)) AS BIGINT) AS size FROM {_ONCE} WHERE book IS NOT NULL GROUP BY book ORDER BY size, book",
}
QUERIES = {k: globals()["blocks" if k == "markdown_blocks" else k] for k in SQL} | {"job_ranks": job_ranks}
