"""Queries on the reviewed navigation: order, targets, coverage of printed contents, edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from folianth.functions import classify, rules
from folianth.functions.rules import as_sql
from folianth.operators import contains, coverage, edits
from folianth.operators.ordered import BUCKET, numbered, scan
from folianth.plans.relations import CASE_DOCS, CASE_DOCS_SQL, CASE_ENTRIES, CASE_ENTRIES_SQL, CASE_ENTRY_SCHEMA, ENTRIES_SQL, entries, literal
from folianth.sources.tables import table, written

PLACED_SQL = f"{ENTRIES_SQL}, placed AS (SELECT entry_id, book, CAST(seq AS BIGINT) AS seq, label, file, block, TRY_CAST(nullif(regexp_extract(file, '([0-9]+)', 1), '') AS BIGINT) * 1000000000 + block AS pos FROM entries)"


#: The placed entries with the cases that the tables have none of.
LISTED_SQL = f"{PLACED_SQL}, listed AS (SELECT * FROM placed UNION ALL {CASE_ENTRIES_SQL})"
DOCS_SQL = f"docs AS (SELECT doc_id, book, chapter_no, text FROM documents UNION ALL {CASE_DOCS_SQL})"


def listed(spark, d):
    """The placed entries, and those of the case book."""
    return placed(spark, d).unionByName(_with_pos(literal(spark, CASE_ENTRY_SCHEMA, CASE_ENTRIES)))


def documents(spark, d):
    """The chapters, and those of the case book."""
    return table(spark, d, "documents").select("doc_id", "book", "chapter_no", "text").unionByName(literal(spark, "doc_id bigint, book string, chapter_no int, text string", CASE_DOCS))


def _with_pos(rows):
    index = F.nullif(F.regexp_extract("file", r"(\d+)", 1), F.lit("")).cast("bigint")
    return rows.select("entry_id", "book", F.col("seq").cast("bigint").alias("seq"), "label", "file", "block", (index * 1_000_000_000 + F.col("block")).alias("pos"))


def placed(spark, d):
    return _with_pos(entries(spark, d))


def _bucket():
    return F.floor(F.col("seq") / BUCKET)


def nav_lag_violations(spark, d):
    """Entries that stand before the entry listed just before them."""
    return _lag(listed(spark, d))


def _lag(rows):
    rows = rows.where(F.col("pos").isNotNull())
    out = scan(rows, ["book"], ["seq", "entry_id"], _bucket(), previous={"before": F.col("pos")})
    return out.where(F.col("pos") < F.col("before")).select("book", "entry_id", "before", "pos")


def nav_running_max_inversions(spark, d):
    """Order and missing targets by book, measured against the furthest place so far, with the first entry that falls behind."""
    rows = scan(listed(spark, d), ["book"], ["seq", "entry_id"], _bucket(), max_before={"far": F.col("pos")})
    back = F.col("far") - F.col("pos")
    printed = classify.printed_label(F.coalesce("label", F.lit("")))
    return rows.groupBy("book").agg(
        F.min_by("label", F.when(back > 0, F.struct("seq", "entry_id"))).alias("first_inversion"), F.count_if(printed).alias("printed_labels"),
        F.count(F.lit(1)).alias("nav_items"), F.count_if(back > 0).alias("order_inversions"), F.greatest(F.coalesce(F.max(back), F.lit(0)), F.lit(0)).alias("largest_backtrack"), F.count_if(F.col("pos").isNull()).alias("missing_targets"),
    )


def nav_worst_books(spark, d):
    """The thirty books with the most inversions."""
    return nav_running_max_inversions(spark, d).orderBy(F.desc("order_inversions"), F.desc("largest_backtrack"), F.asc_nulls_last("book")).limit(30)


def nav_shared_targets(spark, d):
    """Places that several entries lead to, with how many, and the first and the last of their labels."""
    at = F.struct("seq", "entry_id")
    rows = listed(spark, d).where(F.col("pos").isNotNull()).groupBy("book", "pos").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.coalesce("label", F.lit("")), at).alias("first_label"), F.max_by(F.coalesce("label", F.lit("")), at).alias("last_label"))
    return rows.where(F.col("n") > 1)


def nav_playorder_check(spark, d):
    """Entries whose number isn't their place in the book."""
    rows = numbered(listed(spark, d), ["book"], ["seq", "entry_id"], _bucket(), "place")
    return rows.where(F.col("place") != F.col("seq")).select("book", "entry_id", "seq", "place")


def nav_left_spine(spark, d):
    """Entries with the number of their file in the book's reading order, -1 where the book has no such chapter."""
    spine = table(spark, d, "documents").where(F.col("book").isNotNull() & F.col("chapter_no").isNotNull()).select("book", F.format_string("text/split_%03d.html", "chapter_no").alias("file"), F.col("chapter_no").alias("file_index")).distinct()
    return placed(spark, d).join(spine, ["book", "file"], "left").select("entry_id", "book", "file", F.coalesce("file_index", F.lit(-1)).alias("file_index"))


def spec_flatten_preorder(spark, d):
    """The tree of each book in reading order: number, depth, and how many entries stand directly below."""
    e = entries(spark, d).where(F.col("path").isNotNull())
    rows = numbered(e.select("entry_id", "book", "seq", "path", "label"), ["book"], ["path", "entry_id"], F.try_element_at("path", F.lit(1)).cast("bigint") * (1 << 32) + F.floor((F.coalesce(F.try_element_at("path", F.lit(2)), F.lit(-1)) + 1) / 64), "item_no")
    below = e.where(F.col("parent_seq").isNotNull()).groupBy("book", F.col("parent_seq").alias("seq")).agg(F.count(F.lit(1)).alias("children"))
    return rows.join(below, ["book", "seq"], "left").select("entry_id", "book", "item_no", F.size("path").alias("depth"), F.coalesce("children", F.lit(0)).alias("children"), "label")


def nav_duplicate_labels(spark, d):
    return entries(spark, d).groupBy("book").agg(F.count("label").alias("labels"), F.count_distinct("label").alias("distinct_labels")).select("book", "labels", "distinct_labels", F.greatest(F.col("labels") - F.col("distinct_labels"), F.lit(0)).alias("duplicates"))


def acceptance_findings(spark, d):
    """Every failed check of every entry, under a code."""
    p = listed(spark, d)
    hygiene = p.select("book", "entry_id", classify.label_hygiene(F.coalesce("label", F.lit(""))).alias("code")).where(F.col("code").isNotNull())
    missing = p.where(F.col("pos").isNull()).select("book", "entry_id", F.lit("missing target").alias("code"))
    order = _lag(p).select("book", "entry_id", F.lit("not in reading order").alias("code"))
    often = p.where(F.col("pos").isNotNull()).groupBy(F.col("book").alias("b"), F.col("pos").alias("at")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    on = F.col("book").eqNullSafe(F.col("b")) & (F.col("pos") == F.col("at"))
    shared = p.join(often, on, "left_semi").select("book", "entry_id", F.lit("shared target").alias("code"))
    return hygiene.unionByName(missing).unionByName(order).unionByName(shared)


def acceptance_status(spark, d):
    """Findings and verdict by book; a book without findings passes."""
    books = listed(spark, d).groupBy("book").agg(F.count(F.lit(1)).alias("items"))
    bad = acceptance_findings(spark, d).groupBy(F.col("book").alias("b")).agg(F.count(F.lit(1)).alias("findings"))
    return books.join(bad, books["book"].eqNullSafe(bad["b"]), "left").select("book", "items", F.coalesce("findings", F.lit(0)).alias("findings"), F.when(F.col("findings") > 0, "fail").otherwise("pass").alias("status"))


def missing_books_anti(spark, d):
    """Books with entries but no book row, and the other way round."""
    a, b = listed(spark, d).where("book IS NOT NULL").select("book").distinct(), table(spark, d, "spec_books").where("book IS NOT NULL").select("book").distinct()
    return a.join(b, "book", "left_anti").withColumn("missing_in", F.lit("spec_books")).unionByName(b.join(a, "book", "left_anti").withColumn("missing_in", F.lit("spec_entries")))


def uniqueness_checks(spark, d):
    """Tables with their rows, and their rows without second deliveries."""
    out = None
    for name, key in (("spec_entries", "entry_id"), ("spec_books", "book"), ("spec_records", "record_id"), ("content_blocks", "block_id")):
        one = table(spark, d, name).groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.lit(name).alias("name"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("key_count"))
        out = one if out is None else out.unionByName(one)
    return out


def _coverage(spark, d):
    e = entries(spark, d)
    lines, keys = written(coverage.printed_titles(table(spark, d, "printed_lines")), "printed-titles"), coverage.label_keys(e)
    return lines, keys, coverage.accounted(lines, keys)


def coverage_gate(spark, d):
    return _coverage(spark, d)[2]


def coverage_report(spark, d):
    return coverage.by_book(_coverage(spark, d)[2])


def coverage_summary(spark, d):
    b = coverage_report(spark, d)
    return b.agg(F.count(F.lit(1)).alias("books"), F.sum("printed_lines").alias("lines"), F.sum("restored").alias("restored"), F.round(F.median("coverage"), 4).alias("median_coverage"), F.min("coverage").alias("least"), F.max("coverage").alias("most"))


def worst_coverage_topk(spark, d):
    return coverage_report(spark, d).orderBy("coverage", "book").limit(10).select("book", "coverage", "printed_lines")


def unexplained_additions(spark, d):
    lines, keys, _ = _coverage(spark, d)
    return coverage.additions(lines, keys)


def later_label_hits(spark, d):
    """The first later chapter of the same book whose text holds an entry's label (by key, four characters at least)."""
    e = listed(spark, d).where(F.col("pos").isNotNull()).select("entry_id", "book", F.floor(F.col("pos") / 1_000_000_000).alias("file_index"), rules.apply("key_evidence", F.col("label")).alias("needle")).where(F.length("needle") >= 4)
    # only the beginning of a chapter is looked at, as its title stands there
    docs = documents(spark, d).where(F.col("chapter_no").isNotNull() & F.col("text").isNotNull()).select("book", "doc_id", "chapter_no", rules.apply("key_evidence", F.substring("text", 1, 4000)).alias("body"))
    hit = contains.contains_join(e, "needle", docs, "body", "doc_id", on=["book"]).where(F.col("chapter_no") > F.col("file_index"))
    return hit.groupBy("entry_id", "book").agg(F.min("chapter_no").cast("bigint").alias("chapter_no"))


def nav_edge_add(spark, d):
    """Each book's entries with a cover before the first and an end mark after the last, numbered anew."""
    e = placed(spark, d).select("book", "label", F.lit(1).alias("edge"), "seq", "entry_id")
    books = e.select("book").distinct()
    first = books.select("book", F.lit("Cover").alias("label"), F.lit(0).alias("edge"), F.lit(0).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("entry_id"))
    last = first.withColumns({"label": F.lit("End"), "edge": F.lit(2)})
    bucket = F.col("edge") * (1 << 40) + F.floor(F.col("seq") / BUCKET)
    out = numbered(first.unionByName(e).unionByName(last), ["book"], ["edge", "seq", "entry_id"], bucket, "play_order")
    return out.select("book", "label", "play_order")


def nav_label_map(spark, d):
    """Labels replaced where the printed wording is declared; how often the old label stands in the book tells clear from unclear."""
    e = entries(spark, d)
    often = e.groupBy(F.col("book").alias("b"), F.col("label").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    on = F.col("book").eqNullSafe(F.col("b")) & F.col("label").eqNullSafe(F.col("l"))
    return e.join(often, on).select("entry_id", F.when((F.col("printed") != "") & (F.col("n") == 1), F.col("printed")).otherwise(F.col("label")).alias("label"), F.when((F.col("printed") != "") & (F.col("n") > 1), "ambiguous").when(F.col("printed") != "", "renamed").otherwise("kept").alias("outcome"))


def nav_delete(spark, d):
    """Entries that stay when every entry with a declared deviation goes together with all below it."""
    e = entries(spark, d)
    gone = e.where((F.col("deviation") != "") & F.col("path").isNotNull()).select("book", F.col("path").alias("stem"))
    # an entry lies below another if one of the beginnings of its path is the other's path
    stems = e.where(F.col("path").isNotNull()).select("entry_id", "book", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", F.lit(1), n))).alias("stem"))
    below = stems.join(gone, ["book", "stem"], "left_semi").select("entry_id").distinct()
    return e.join(below, "entry_id", "left_anti").select("entry_id", "book", "label")


def nav_move(spark, d):
    """The last top-level entry of each book moved before its first, with all below it; books where a label stands twice stay as they are."""
    e = entries(spark, d).where(F.col("path").isNotNull() & F.col("book").isNotNull()).select("book", "entry_id", "path", "label")
    tops = e.where(F.size("path") == 1).groupBy("book").agg(F.max_by("label", F.struct("path", "entry_id")).alias("label"), F.min_by("label", F.struct("path", "entry_id")).alias("before"), F.count(F.lit(1)).alias("n"))
    return edits.moved(e, tops.where("n > 1").select("book", F.lit(1).alias("ord"), "label", "before"))


def drift_report(spark, d):
    """Entries whose expected text is stale: it isn't the label, nor a beginning of it, once white space is dropped."""
    a, b = rules.apply("fingerprint", F.col("label")), rules.apply("fingerprint", F.col("expect"))
    return entries(spark, d).where(F.col("expect").isNotNull() & F.col("label").isNotNull() & ~a.startswith(b)).select("entry_id", "book", a.alias("label_print"), b.alias("expect_print"))


def decision_counts(spark, d):
    return entries(spark, d).select(F.when(F.col("deviation") != "", "deviation").when(F.col("printed") != "", "renamed").when(F.col("block").isNull(), "unplaced").otherwise("plain").alias("decision")).groupBy("decision").agg(F.count(F.lit(1)).alias("entries"))


_HYGIENE = classify.label_hygiene.sql("coalesce(label, '')")
_LAG = f"{LISTED_SQL}, lagged AS (SELECT book, entry_id, pos, lag(pos) OVER (PARTITION BY book ORDER BY seq, entry_id) AS before FROM listed WHERE pos IS NOT NULL)"
_RUN = f"{LISTED_SQL}, run AS (SELECT *, max(pos) OVER (PARTITION BY book ORDER BY seq, entry_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - pos AS back FROM listed), audit AS (SELECT book, arg_min(label, (seq, entry_id)) FILTER (back > 0) AS first_inversion, count(*) FILTER ({classify.printed_label.sql("coalesce(label, '')")}) AS printed_labels, count(*) AS nav_items, count(*) FILTER (back > 0) AS order_inversions, greatest(coalesce(max(back), 0), 0) AS largest_backtrack, count(*) FILTER (pos IS NULL) AS missing_targets FROM run GROUP BY book)"
_FINDINGS = f"{_LAG}, findings AS (SELECT book, entry_id, {_HYGIENE} AS code FROM listed WHERE {_HYGIENE} IS NOT NULL UNION ALL SELECT book, entry_id, 'missing target' FROM listed WHERE pos IS NULL UNION ALL SELECT book, entry_id, 'not in reading order' FROM lagged WHERE pos < before UNION ALL SELECT book, entry_id, 'shared target' FROM (SELECT *, count(*) OVER (PARTITION BY book, pos) AS n FROM listed WHERE pos IS NOT NULL) WHERE n > 1)"
_KEY = lambda x: as_sql("key_coverage", x)
_RENAMED = f" UNION ALL SELECT book, {_KEY('printed')}, 2, false FROM entries WHERE printed <> ''"
_PRINTED = f"""{ENTRIES_SQL}, one AS (SELECT book, CAST(line_no AS BIGINT) AS line_no, any_value(line) AS line FROM printed_lines WHERE book IS NOT NULL AND line IS NOT NULL GROUP BY book, line_no), hits AS (SELECT *, {classify.toc_line.sql('line')} AS hit FROM one),
open AS (SELECT book FROM hits GROUP BY book HAVING count(*) FILTER (hit) >= 5 AND count(*) FILTER (hit) >= 0.4 * count(*)), cut AS (SELECT book, line_no, {as_sql('page_suffix', 'line')} AS line FROM hits WHERE hit AND book IN (SELECT book FROM open)),
toc AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY line_no) AS i, lead(line) OVER (PARTITION BY book ORDER BY line_no) AS next FROM cut WHERE length(line) >= 2 AND NOT regexp_matches(line, {rules.quoted(classify.PAGE_ONLY)}) AND NOT regexp_matches(line, {rules.quoted(classify.TOC_WORD)})),
keys AS (SELECT book, k, min(r) AS r, bool_or(dev) AS dev FROM (SELECT book, {_KEY('label')} AS k, 1 AS r, coalesce(deviation <> '', false) AS dev FROM entries{_RENAMED}) WHERE length(k) > 0 GROUP BY book, k)"""
_FOLD = f"""WITH RECURSIVE {_PRINTED}, m AS (SELECT toc.*, a.r AS r1, b.r AS r2 FROM toc LEFT JOIN keys a ON a.book = toc.book AND a.k = {_KEY('line')} LEFT JOIN keys b ON b.book = toc.book AND b.k = {_KEY("line || next")}),
s AS (SELECT *, coalesce(r2 IS NOT NULL AND NOT (r1 IS NOT NULL AND r1 <= r2), false) AS pair, least(r1, r2) AS own FROM m),
f AS (SELECT book, i, line_no, line, false AS taken, pair AS takes, own AS rank FROM s WHERE i = 1 UNION ALL SELECT s.book, s.i, s.line_no, s.line, f.takes, NOT f.takes AND s.pair, CASE WHEN f.takes THEN f.rank ELSE s.own END FROM f JOIN s ON s.book = f.book AND s.i = f.i + 1),
verdicts AS (SELECT book, line_no, line, taken, CASE WHEN rank <= 2 THEN 'restored' ELSE 'silent' END AS verdict FROM f),
report AS (SELECT book, count(*) AS printed_lines, count(*) FILTER (verdict = 'restored') AS restored, CAST(0 AS BIGINT) AS explained, count(*) FILTER (verdict = 'silent') AS silent, round(count(*) FILTER (verdict = 'restored') / count(*), 4) AS coverage FROM verdicts GROUP BY book)"""
_EVIDENCE = lambda x: as_sql("key_evidence", x)

SQL = {
    "nav_lag_violations": f"WITH {_LAG} SELECT book, entry_id, before, pos FROM lagged WHERE pos < before",
    "nav_running_max_inversions": f"WITH {_RUN} SELECT * FROM audit",
    "nav_worst_books": f"WITH {_RUN} SELECT * FROM audit ORDER BY order_inversions DESC, largest_backtrack DESC, book ASC NULLS LAST LIMIT 30",
    "nav_shared_targets": f"WITH {LISTED_SQL} SELECT book, pos, count(*) AS n, arg_min(coalesce(label, ''), (seq, entry_id)) AS first_label, arg_max(coalesce(label, ''), (seq, entry_id)) AS last_label FROM listed WHERE pos IS NOT NULL GROUP BY book, pos HAVING count(*) > 1",
    "nav_playorder_check": f"WITH {LISTED_SQL} SELECT book, entry_id, seq, place FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY seq, entry_id) AS place FROM listed) WHERE place <> seq",
    "nav_left_spine": f"WITH {PLACED_SQL}, spine AS (SELECT DISTINCT book, format('text/split_{{:03d}}.html', chapter_no) AS file, chapter_no FROM documents WHERE book IS NOT NULL AND chapter_no IS NOT NULL) SELECT entry_id, placed.book, placed.file, coalesce(chapter_no, -1) AS file_index FROM placed LEFT JOIN spine ON spine.book = placed.book AND spine.file = placed.file",
    "spec_flatten_preorder": f"WITH {ENTRIES_SQL} SELECT e.entry_id, e.book, row_number() OVER (PARTITION BY e.book ORDER BY e.path, e.entry_id) AS item_no, len(e.path) AS depth, (SELECT count(*) FROM entries c WHERE c.book = e.book AND c.parent_seq = e.seq AND c.path IS NOT NULL) AS children, e.label FROM entries e WHERE e.path IS NOT NULL",
    "nav_duplicate_labels": f"WITH {ENTRIES_SQL} SELECT book, count(label) AS labels, count(DISTINCT label) AS distinct_labels, greatest(count(label) - count(DISTINCT label), 0) AS duplicates FROM entries GROUP BY book",
    "acceptance_findings": f"WITH {_FINDINGS} SELECT * FROM findings",
    "acceptance_status": f"WITH {_FINDINGS} SELECT e.book, e.items, coalesce(f.n, 0) AS findings, CASE WHEN f.n > 0 THEN 'fail' ELSE 'pass' END AS status FROM (SELECT book, count(*) AS items FROM listed GROUP BY book) e LEFT JOIN (SELECT book, count(*) AS n FROM findings GROUP BY book) f ON e.book IS NOT DISTINCT FROM f.book",
    "missing_books_anti": f"WITH {LISTED_SQL} SELECT DISTINCT book, 'spec_books' AS missing_in FROM listed WHERE book IS NOT NULL AND book NOT IN (SELECT book FROM spec_books WHERE book IS NOT NULL) UNION ALL SELECT DISTINCT book, 'spec_entries' FROM spec_books WHERE book IS NOT NULL AND book NOT IN (SELECT book FROM listed WHERE book IS NOT NULL)",
    "uniqueness_checks": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS row_count, count(DISTINCT {k}) AS key_count FROM {n}" for n, k in (("spec_entries", "entry_id"), ("spec_books", "book"), ("spec_records", "record_id"), ("content_blocks", "block_id"))),
    "coverage_gate": f"{_FOLD} SELECT * FROM verdicts",
    "coverage_report": f"{_FOLD} SELECT * FROM report",
    "coverage_summary": f"{_FOLD} SELECT count(*) AS books, CAST(sum(printed_lines) AS BIGINT) AS lines, CAST(sum(restored) AS BIGINT) AS restored, round(median(coverage), 4) AS median_coverage, min(coverage) AS least, max(coverage) AS most FROM report",
    "worst_coverage_topk": f"{_FOLD} SELECT book, coverage, printed_lines FROM report ORDER BY coverage, book LIMIT 10",
    "unexplained_additions": f"WITH {_PRINTED}, shown AS (SELECT book, {_KEY('line')} AS k FROM toc UNION SELECT book, {_KEY('line || next')} FROM toc WHERE next IS NOT NULL) SELECT DISTINCT keys.book, keys.k AS key FROM keys WHERE r = 1 AND NOT dev AND book IN (SELECT book FROM toc) AND NOT EXISTS (SELECT 1 FROM shown WHERE shown.book = keys.book AND shown.k = keys.k)",
    "later_label_hits": f"WITH {LISTED_SQL}, {DOCS_SQL}, e AS (SELECT entry_id, book, pos // 1000000000 AS file_index, {_EVIDENCE('label')} AS needle FROM listed WHERE pos IS NOT NULL), t AS (SELECT book, chapter_no, {_EVIDENCE('substring(text, 1, 4000)')} AS body FROM docs WHERE chapter_no IS NOT NULL AND text IS NOT NULL) SELECT entry_id, e.book, CAST(min(chapter_no) AS BIGINT) AS chapter_no FROM e JOIN t ON e.book = t.book AND chapter_no > file_index AND length(needle) >= 4 AND contains(body, needle) GROUP BY entry_id, e.book",
    "nav_edge_add": f"WITH {PLACED_SQL}, allrows AS (SELECT book, label, 1 AS edge, seq, entry_id FROM placed UNION ALL SELECT DISTINCT book, 'Cover', 0, 0, 0 FROM placed UNION ALL SELECT DISTINCT book, 'End', 2, 0, 0 FROM placed) SELECT book, label, row_number() OVER (PARTITION BY book ORDER BY edge, seq, entry_id) AS play_order FROM allrows",
    "nav_label_map": f"WITH {ENTRIES_SQL}, c AS (SELECT *, count(*) OVER (PARTITION BY book, label) AS n FROM entries) SELECT entry_id, CASE WHEN printed <> '' AND n = 1 THEN printed ELSE label END AS label, CASE WHEN printed <> '' AND n > 1 THEN 'ambiguous' WHEN printed <> '' THEN 'renamed' ELSE 'kept' END AS outcome FROM c",
    "nav_delete": f"WITH {ENTRIES_SQL} SELECT entry_id, book, label FROM entries e WHERE NOT EXISTS (SELECT 1 FROM entries g WHERE g.book = e.book AND g.deviation <> '' AND g.path IS NOT NULL AND e.path[1:len(g.path)] = g.path)",
    "nav_move": f"""WITH {ENTRIES_SQL}, e AS (SELECT book, entry_id, path, label FROM entries WHERE path IS NOT NULL AND book IS NOT NULL), tops AS (SELECT book, path[1] AS top, label, row_number() OVER (PARTITION BY book ORDER BY path, entry_id) AS i, row_number() OVER (PARTITION BY book ORDER BY path DESC, entry_id DESC) AS back, count(*) OVER (PARTITION BY book) AS n, count(*) OVER (PARTITION BY book, label) AS twins FROM e WHERE len(path) = 1),
    ask AS (SELECT a.book, a.top AS moving, b.top AS goal, CASE WHEN a.label IS NULL OR b.label IS NULL THEN 'missing label' WHEN a.twins > 1 OR b.twins > 1 THEN 'label not unique' END AS error FROM tops a JOIN tops b ON a.book = b.book AND a.back = 1 AND b.i = 1 WHERE a.n > 1),
    keyed AS (SELECT e.*, ask.error, CASE WHEN ask.error IS NULL AND e.path[1] = ask.moving THEN ask.goal ELSE e.path[1] END AS k1, CASE WHEN ask.error IS NULL AND e.path[1] = ask.moving THEN 0 ELSE 1 END AS k2 FROM e LEFT JOIN ask ON ask.book = e.book)
    SELECT book, entry_id, label, row_number() OVER (PARTITION BY book ORDER BY k1, k2, path, entry_id) AS play_order, error FROM keyed""",
    "drift_report": f"WITH {ENTRIES_SQL} SELECT entry_id, book, {as_sql('fingerprint', 'label')} AS label_print, {as_sql('fingerprint', 'expect')} AS expect_print FROM entries WHERE expect IS NOT NULL AND label IS NOT NULL AND NOT starts_with({as_sql('fingerprint', 'label')}, {as_sql('fingerprint', 'expect')})",
    "decision_counts": f"WITH {ENTRIES_SQL} SELECT CASE WHEN deviation <> '' THEN 'deviation' WHEN printed <> '' THEN 'renamed' WHEN block IS NULL THEN 'unplaced' ELSE 'plain' END AS decision, count(*) AS entries FROM entries GROUP BY 1",
}
QUERIES = {k: globals()[k] for k in SQL}
