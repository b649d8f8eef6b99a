"""Queries that audit whole tables: gates by file, counts, packets of evidence, drift of coordinates, corrections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folianth.functions import classify, rules
from folianth.functions.rules import as_sql, quoted
from folianth.operators import coverage, layout
from folianth.operators import lookup as L
from folianth.operators.ordered import BUCKET, numbered, scan
from folianth.plans import navigation, pages
from folianth.plans.relations import ENTRIES_SQL, LINES_SQL, entries, lines
from folianth.sources.tables import table


def toc_file_gate(spark, d):
    """Chapters that are printed contents: at least five lines with a locator, and two fifths of all lines with text."""
    rows = lines(spark, d).where(F.length(rules.apply(rules.STRIP, F.col("line"))) > 0)
    n = rows.groupBy("doc_id").agg(F.count_if(classify.toc_line(F.col("line"))).alias("hits"), F.count(F.lit(1)).alias("blocks"))
    return n.where((F.col("hits") >= 5) & (F.col("hits") >= 0.4 * F.col("blocks")))


def probable_toc_lines(spark, d):
    """How many lines of each book look like lines of printed contents."""
    return lines(spark, d).where("book IS NOT NULL").groupBy("book").agg(F.count_if(classify.probable_toc_line(F.col("line"))).alias("probable"), F.count(F.lit(1)).alias("n_lines"))


def layout_type_json(spark, d):
    """Types of layout items by source as a JSON object with sorted keys."""
    n = table(spark, d, "content_blocks").dropDuplicates(["block_id"]).where("type IS NOT NULL").groupBy("source", "type").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("source").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n"))))).alias("types"))


def visuals_with_path(spark, d):
    """Items and items with a picture, by source: the picture's path stands in one of three places."""
    item = F.col("item")
    path = F.coalesce(*(F.nullif(F.get_json_object(item, p), F.lit("")) for p in ("$.content.image_source.path", "$.img_path", "$.image_path")))
    one = table(spark, d, "content_blocks").dropDuplicates(["block_id"]).select("source", path.alias("path"))
    return one.groupBy("source").agg(F.count(F.lit(1)).alias("items"), F.count("path").alias("with_path"))


def layout_block_filter_rich(spark, d):
    """Layout items that are part of the rich text, by type."""
    items = table(spark, d, "content_blocks").select("block_id", "type").distinct()
    return items.where(~F.col("type").isin(classify.RICH_SKIPPED_TYPES)).groupBy("type").agg(F.count(F.lit(1)).alias("items"))


def plain_fallback(spark, d):
    """Texts without lines that are page numbers, by hash and size."""
    t = layout.plain_fallback(F.col("text"))
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.length(t).alias("chars"), F.sha2(t, 256).alias("sha256"))


def findings_by_book(spark, d):
    """Findings of each book: how many, and the first five of its entries with their codes as one text."""
    f = navigation.acceptance_findings(spark, d).where("book IS NOT NULL")
    # only the five least entries of a book are needed; a code at a time keeps the groups small
    place = F.struct("entry_id", "code")
    first = f.select("book", "entry_id", "code").withColumn("k", F.row_number().over(Window.partitionBy("book", "code").orderBy("entry_id"))).where("k <= 5")
    text = first.groupBy("book").agg(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(place)), 1, 5), lambda x: F.concat(x["entry_id"].cast("string"), F.lit(": "), x["code"])), " | ").alias("first"))
    return f.groupBy("book").agg(F.count(F.lit(1)).alias("findings")).join(text, "book")


def structure_counts(spark, d):
    """Entries by depth, and whether every entry below the top has its parent: the figures that a reviewed structure is asserted by."""
    e = entries(spark, d).where("path IS NOT NULL AND book IS NOT NULL")
    parents = e.select("book", F.col("path").alias("above")).distinct().withColumn("found", F.lit(1))
    rows = e.withColumn("above", F.slice("path", F.lit(1), F.greatest(F.size("path") - 1, F.lit(0)))).join(parents, ["book", "above"], "left")
    return rows.groupBy(F.size("path").alias("depth")).agg(F.count(F.lit(1)).alias("entries"), F.count_if((F.size("path") > 1) & F.col("found").isNull()).alias("orphans"))


def coordinate_drift(spark, d):
    """Placed entries whose expected text isn't at their coordinate, with the text that stands there and around it."""
    e = entries(spark, d).where("book IS NOT NULL AND file IS NOT NULL AND block IS NOT NULL").select("entry_id", "book", F.nullif(F.regexp_extract("file", "([0-9]+)", 1), F.lit("")).cast("int").alias("chapter_no"), "block", F.coalesce("expect", F.lit("")).alias("expect"))
    chapters = table(spark, d, "documents").where("book IS NOT NULL AND chapter_no IS NOT NULL AND text IS NOT NULL").groupBy("book", "chapter_no").agg(F.min("doc_id").alias("doc_id"))
    b = pages.blocks(spark, d).select("doc_id", (F.col("block_no") - 1).cast("int").alias("block"), "text")
    at = e.join(chapters, ["book", "chapter_no"]).join(b, ["doc_id", "block"], "left")
    mark = lambda c: rules.apply("fingerprint", F.coalesce(F.col(c), F.lit("")))
    drift = F.when(F.col("text").isNull(), "no such block").when(mark("expect") == "", "no expected text").when(~F.contains(mark("text"), mark("expect")), "other text")
    return at.select("entry_id", "doc_id", "block", F.substring("text", 1, 80).alias("found"), drift.alias("drift")).where("drift IS NOT NULL")


def corrections(spark, d):
    """Reviewed corrections of one book after another: entries numbered, the places where the printed lines differ, and what insertions shift.

    The i-th printed line meets the i-th label; a difference that the entry declares is an exception, any other is drift; every declared
    deviation inserts a line, so later places move by the number of those before them.
    """
    e = entries(spark, d).where("book IS NOT NULL").select("book", "entry_id", F.col("seq").cast("bigint").alias("seq"), "label", (F.coalesce(F.length("deviation"), F.lit(0)) > 0).alias("declared"))
    bucket = F.floor(F.col("seq") / BUCKET)
    rows = scan(numbered(e, ["book"], ["seq", "entry_id"], bucket, "i"), ["book"], ["seq", "entry_id"], bucket, sum_before={"shift": F.col("declared").cast("bigint")})
    p = table(spark, d, "printed_lines").where("book IS NOT NULL").groupBy("book", "line_no").agg(F.min("line").alias("line"))
    p = numbered(p.withColumn("seq", F.col("line_no").cast("bigint")), ["book"], ["seq"], bucket, "i").select("book", "i", rules.apply("key_coverage", rules.apply("page_suffix", F.col("line"))).alias("printed"))
    met = rows.join(p, ["book", "i"]).withColumn("key", rules.apply("key_coverage", F.col("label")))
    return met.where(~F.col("key").eqNullSafe(F.col("printed"))).select("book", "entry_id", "i", "shift", F.when(F.col("declared"), "exception").otherwise("drift").alias("verdict"))


def coverage_report_mode(spark, d):
    """Coverage against the navigation alone, without what a review declares: matched lines, share, and the first five that nothing matches."""
    lines_ = navigation.written(coverage.printed_titles(table(spark, d, "printed_lines")), "printed-titles")
    nav = coverage.label_keys(entries(spark, d).select("book", "label", F.lit(None).cast("string").alias("deviation"), F.lit(None).cast("string").alias("printed")))
    verdicts = navigation.written(coverage.accounted(lines_, nav), "report-verdicts")
    left = verdicts.where("verdict = 'silent'").select("book", "line_no", F.substring("line", 1, 40).alias("line")).withColumn("k", F.row_number().over(Window.partitionBy("book").orderBy("line_no"))).where("k <= 5")
    samples = left.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), " | ").alias("unmatched"))
    return coverage.by_book(verdicts).join(samples, "book", "left").select("book", "printed_lines", F.col("restored").alias("matched"), "coverage", "unmatched")


def packet_summary(spark, d):
    """Figures of every chapter's review packet: blocks, windows of printed contents, structural hits, probable contents lines."""
    b = pages.blocks(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(classify.probable_toc_line(F.col("text"))).alias("probable"))
    w = pages.toc_windows(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("windows"))
    h = pages.structural_hits(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return b.join(w, "doc_id", "left").join(h, "doc_id", "left").select("doc_id", "blocks", "probable", zero("windows"), zero("hits"))


def review_packets(spark, d):
    """The review packet of every chapter as Markdown: figures, printed contents, structural places with what stands around them."""
    w = pages.toc_windows(spark, d).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x, i: F.concat(F.lit("### Window "), (i + 1).cast("string"), F.lit(": block "), x["start"].cast("string"), F.lit("\n\n```text\n"), x["text"], F.lit("\n```\n"))), "").alias("windows_text"))
    h = pages.structural_hits(spark, d).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "tag", "text", "context"))), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". block "), x["block_no"].cast("string"), F.lit(" `<"), x["tag"], F.lit(">`: "), x["text"], F.lit("\n   Context: "), x["context"], F.lit("\n"))), "").alias("hits_text"))
    s = packet_summary(spark, d).join(w, "doc_id", "left").join(h, "doc_id", "left")
    head = F.concat(F.lit("# "), F.col("doc_id").cast("string"), F.lit("\n\n- text_blocks: "), F.col("blocks").cast("string"), F.lit("\n- printed_toc_windows: "), F.col("windows").cast("string"), F.lit("\n- structural_hits: "), F.col("hits").cast("string"), F.lit("\n\n## Printed contents\n\n"))
    body = F.concat(head, F.coalesce("windows_text", F.lit("None found.\n")), F.lit("\n## Structural places\n\n"), F.coalesce("hits_text", F.lit("")))
    return s.select("doc_id", F.length(body).alias("chars"), F.sha2(body, 256).alias("sha256"), F.substring(body, 1, 200).alias("head"))


def evidence_summary(spark, d):
    """Figures of each book's navigation: entries, printed labels, body list labels, and entries of which a later one has the same title."""
    e = entries(spark, d).where("book IS NOT NULL")
    label = F.coalesce("label", F.lit(""))
    n = e.groupBy("book").agg(F.count(F.lit(1)).alias("nav_items"), F.count_if(label.rlike(rules.LOCATOR)).alias("printed_nav"), F.count_if(classify.body_list_label(label)).alias("body_list_nav"))
    twice = L.later_duplicates(navigation.placed(spark, d).where("book IS NOT NULL")).groupBy("book").agg(F.count(F.lit(1)).alias("repeated"))
    return n.join(twice, "book", "left").select("book", "nav_items", "printed_nav", "body_list_nav", F.coalesce("repeated", F.lit(0)).alias("repeated"))


def capped_findings(spark, d):
    """The first thirty findings of the corpus, as a report ends."""
    return navigation.acceptance_findings(spark, d).orderBy(F.asc_nulls_last("book"), "entry_id", "code").limit(30)


_ONCE = pages._ONCE
_WINDOWS = pages.SQL["toc_windows"].split(" SELECT ts.doc_id", 1)[0].removeprefix("WITH ").rstrip()
_WIN_ROWS = f"{_WINDOWS}, wins AS (SELECT ts.doc_id, start, n_blocks, substring(string_agg('[' || block_no || ':' || tag || '] ' || text, chr(10) ORDER BY block_no), 1, 30000) AS text FROM ts JOIN blocks b ON b.doc_id = ts.doc_id AND block_no BETWEEN start AND start + greatest(n_blocks, 1) - 1 GROUP BY ts.doc_id, start, n_blocks)"
_HITS = "sw AS (SELECT *, array_to_string(list(text) OVER (PARTITION BY doc_id ORDER BY block_no ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING), ' | ') AS around FROM blocks), hits AS (SELECT doc_id, block_no, tag, text, substring(around, 1, 1000) AS context FROM sw WHERE " + pages.SQL["structural_hits"].split(" FROM w WHERE ", 1)[1] + ")"
_PACKETS = f"{_WIN_ROWS}, {_HITS}, summary AS (SELECT b.*, coalesce(n, 0) AS windows, coalesce(m, 0) AS hits FROM (SELECT doc_id, count(*) AS blocks, count(*) FILTER ({classify.probable_toc_line.sql('text')}) AS probable FROM blocks GROUP BY doc_id) b LEFT JOIN (SELECT doc_id, count(*) AS n FROM wins GROUP BY doc_id) USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS m FROM hits GROUP BY doc_id) USING (doc_id))"
_LATER = f"""{navigation.PLACED_SQL}, keyed AS (SELECT book, entry_id, seq, {as_sql('key_printed', 'label')} AS key, {rules.ordinal_prefix_sql('label')} AS ordinal FROM placed WHERE book IS NOT NULL),
later AS (SELECT DISTINCT a.book, a.entry_id FROM keyed a JOIN keyed b ON a.book = b.book AND b.seq > a.seq AND (a.key <> '' AND b.key <> '' AND (contains(b.key, a.key) OR contains(a.key, b.key)) OR a.ordinal <> '' AND a.ordinal = b.ordinal))"""
_FALLBACK = f"regexp_replace(array_to_string(list_transform(list_filter(string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: NOT regexp_matches(x, {quoted(classify.PAGE_LINE)})), lambda x: regexp_replace(x, {quoted(rules.SP + '+$')}, '')), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')"
_FALLBACK = _FALLBACK.replace("{{3,}}", "{3,}")
SQL = {
    "toc_file_gate": f"WITH {LINES_SQL} SELECT doc_id, count(*) FILTER ({classify.toc_line.sql('line')}) AS hits, count(*) AS blocks FROM lines WHERE length({as_sql(rules.STRIP, 'line')}) > 0 GROUP BY doc_id HAVING count(*) FILTER ({classify.toc_line.sql('line')}) >= 5 AND count(*) FILTER ({classify.toc_line.sql('line')}) >= 0.4 * count(*)",
    "probable_toc_lines": f"WITH {LINES_SQL} SELECT book, count(*) FILTER ({classify.probable_toc_line.sql('line')}) AS probable, count(*) AS n_lines FROM lines WHERE book IS NOT NULL GROUP BY book",
    "layout_type_json": f"SELECT source, '{{' || string_agg('\"' || type || '\":' || n, ',' ORDER BY type) || '}}' AS types FROM (SELECT source, type, count(*) AS n FROM {_ONCE} WHERE type IS NOT NULL GROUP BY source, type) GROUP BY source",
    "visuals_with_path": f"SELECT source, count(*) AS items, count(CASE WHEN json_valid(item) THEN coalesce(nullif(item ->> '$.content.image_source.path', ''), nullif(item ->> '$.img_path', ''), nullif(item ->> '$.image_path', '')) END) AS with_path FROM {_ONCE} GROUP BY source",
    "layout_block_filter_rich": "SELECT type, count(*) AS items FROM (SELECT DISTINCT block_id, type FROM content_blocks) WHERE type NOT IN ('page_header', 'page_footer', 'page_number', 'page_aside_text') GROUP BY type",
    "plain_fallback": f"SELECT doc_id, CAST(length(t) AS INTEGER) AS chars, sha256(t) AS sha256 FROM (SELECT doc_id, {as_sql(rules.STRIP, _FALLBACK)} || chr(10) AS t FROM documents WHERE text IS NOT NULL)",
    "findings_by_book": f"WITH {navigation._FINDINGS}, k AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY entry_id, code) AS k FROM findings WHERE book IS NOT NULL) SELECT book, count(*) AS findings, string_agg(entry_id || ': ' || code, ' | ' ORDER BY entry_id, code) FILTER (k <= 5) AS first FROM k GROUP BY book",
    "structure_counts": f"WITH {ENTRIES_SQL}, e AS (SELECT * FROM entries WHERE path IS NOT NULL AND book IS NOT NULL) SELECT CAST(len(path) AS INTEGER) AS depth, count(*) AS entries, count(*) FILTER (len(path) > 1 AND NOT EXISTS (SELECT 1 FROM e p WHERE p.book = e.book AND p.path = e.path[1:len(e.path) - 1])) AS orphans FROM e GROUP BY len(path)",
    "coordinate_drift": f"""WITH {pages._BLOCKS}, {ENTRIES_SQL}, e AS (SELECT entry_id, book, TRY_CAST(nullif(regexp_extract(file, '([0-9]+)', 1), '') AS INTEGER) AS chapter_no, block, coalesce(expect, '') AS expect FROM entries WHERE book IS NOT NULL AND file IS NOT NULL AND block IS NOT NULL),
    ch AS (SELECT book, chapter_no, min(doc_id) AS doc_id FROM documents WHERE book IS NOT NULL AND chapter_no IS NOT NULL AND text IS NOT NULL GROUP BY book, chapter_no), m AS (SELECT e.entry_id, ch.doc_id, e.block, b.text, {as_sql('fingerprint', 'e.expect')} AS want, {as_sql('fingerprint', "coalesce(b.text, '')")} AS got FROM e JOIN ch ON ch.book = e.book AND ch.chapter_no = e.chapter_no LEFT JOIN blocks b ON b.doc_id = ch.doc_id AND b.block_no - 1 = e.block)
    SELECT entry_id, doc_id, block, substring(text, 1, 80) AS found, CASE WHEN text IS NULL THEN 'no such block' WHEN want = '' THEN 'no expected text' ELSE 'other text' END AS drift FROM m WHERE text IS NULL OR want = '' OR NOT contains(got, want)""",
    "corrections": f"""WITH {ENTRIES_SQL}, e AS (SELECT book, entry_id, seq, label, coalesce(deviation <> '', false) AS declared, row_number() OVER (PARTITION BY book ORDER BY seq, entry_id) AS i FROM entries WHERE book IS NOT NULL), s AS (SELECT *, CAST(coalesce(sum(CASE WHEN declared THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY seq, entry_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS shift, {as_sql('key_coverage', 'label')} AS key FROM e),
    p AS (SELECT book, row_number() OVER (PARTITION BY book ORDER BY line_no) AS i, {as_sql('key_coverage', as_sql('page_suffix', 'line'))} AS printed FROM (SELECT book, line_no, min(line) AS line FROM printed_lines WHERE book IS NOT NULL GROUP BY book, line_no)) SELECT s.book, entry_id, s.i, shift, CASE WHEN declared THEN 'exception' ELSE 'drift' END AS verdict FROM s JOIN p ON p.book = s.book AND p.i = s.i WHERE key IS DISTINCT FROM printed""",
    "coverage_report_mode": navigation._FOLD.replace(navigation._RENAMED, "") + " SELECT r.book, r.printed_lines, r.restored AS matched, r.coverage, u.unmatched FROM report r LEFT JOIN (SELECT book, string_agg(substring(line, 1, 40), ' | ' ORDER BY line_no) AS unmatched FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY line_no) AS k FROM verdicts WHERE verdict = 'silent') WHERE k <= 5 GROUP BY book) u ON u.book = r.book",
    "packet_summary": f"WITH {_PACKETS} SELECT * FROM summary",
    "review_packets": f"""WITH {_PACKETS}, wt AS (SELECT doc_id, string_agg('### Window ' || k || ': block ' || start || chr(10) || chr(10) || '```text' || chr(10) || text || chr(10) || '```' || chr(10), '' ORDER BY start) AS t FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS k FROM wins) GROUP BY doc_id),
    ht AS (SELECT doc_id, string_agg(k || '. block ' || block_no || ' `<' || tag || '>`: ' || text || chr(10) || '   Context: ' || context || chr(10), '' ORDER BY block_no) AS t FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY block_no) AS k FROM hits) GROUP BY doc_id),
    body AS (SELECT summary.doc_id, '# ' || summary.doc_id || chr(10) || chr(10) || '- text_blocks: ' || blocks || chr(10) || '- printed_toc_windows: ' || windows || chr(10) || '- structural_hits: ' || hits || chr(10) || chr(10) || '## Printed contents' || chr(10) || chr(10) || coalesce(wt.t, 'None found.' || chr(10)) || chr(10) || '## Structural places' || chr(10) || chr(10) || coalesce(ht.t, '') AS body FROM summary LEFT JOIN wt USING (doc_id) LEFT JOIN ht USING (doc_id)) SELECT doc_id, CAST(length(body) AS INTEGER) AS chars, sha256(body) AS sha256, substring(body, 1, 200) AS head FROM body""",
    "evidence_summary": f"WITH {_LATER}, n AS (SELECT book, count(*) AS nav_items, count(*) FILTER (regexp_matches(coalesce(label, ''), {quoted(rules.LOCATOR)})) AS printed_nav, count(*) FILTER ({classify.body_list_label.sql(chr(99) + 'oalesce(label, ' + quoted('') + ')')}) AS body_list_nav FROM entries WHERE book IS NOT NULL GROUP BY book) SELECT n.*, coalesce(r.n, 0) AS repeated FROM n LEFT JOIN (SELECT book, count(*) AS n FROM later GROUP BY book) r ON r.book = n.book",
    "capped_findings": f"WITH {navigation._FINDINGS} SELECT * FROM findings ORDER BY book ASC NULLS LAST, entry_id, code LIMIT 30",
}
QUERIES = {k: globals()[k] for k in SQL}
