"""Queries on stated cases: what the tables have none of, as literal rows for both engines.

The SQL twins state by hand what must come out; they share no pattern with the operators.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from folianth.functions import rules
from folianth.operators import coverage, edits, layout
from folianth.operators import lookup as L
from folianth.plans.relations import literal, values_sql
from folianth.sources import files
from folianth.sources.tables import shared_dir, written

# --- coverage of printed contents, with what the review declares

_PRINTED = ["第一讲 潮汐……4", "第二讲 灯塔……18", "第三讲 归航……37", "附表 潮位……52", "谢词……60"]
_THREE = ["第一讲 潮汐", "第二讲 灯塔", "第三讲 归航"]
#: (book, printed lines, entries (label, printed, deviation), declared as dropped)
_BOOKS = [
    ("whole", _PRINTED, [(x, None, None) for x in [*_THREE, "附表 潮位", "谢词"]], []),
    ("declared", _PRINTED, [*((x, None, None) for x in _THREE), ("尾声", None, "加入正文的尾声")], ["附表 潮位", "谢词"]),
    ("silent", _PRINTED, [*((x, None, None) for x in _THREE), ("尾声", None, "加入正文的尾声")], ["附表 潮位"]),
    ("added", _PRINTED, [*((x, None, None) for x in _THREE), ("尾声", None, None)], ["附表 潮位", "谢词"]),
    ("damaged", [*_PRINTED[:2], "第三讲 归舫……37", *_PRINTED[3:]], [*((x, None, None) for x in _THREE[:2]), ("第三讲 归航", "第三讲 归舫", "印行有损"), ("附表 潮位", None, None), ("谢词", None, None)], []),
    ("undeclared", [*_PRINTED[:2], "第三讲 归舫……37", *_PRINTED[3:]], [*((x, None, None) for x in _THREE[:2]), ("第三讲 归航", None, "印行有损"), ("附表 潮位", None, None), ("谢词", None, None)], []),
    ("wrapped", [*_PRINTED[:3], "漫长的海岸|", "线画得完整……71"], [*((x, None, None) for x in _THREE), ("漫长的海岸线画得完整", None, None)], []),
    ("prose", ["第一讲 潮汐……4", "这一天没有风。", "船停在港里。"], [("第一讲 潮汐", None, None)], []),
]


def _coverage(spark):
    lines = literal(spark, "book string, line_no int, line string", [(b, i, x) for b, ls, _, _ in _BOOKS for i, x in enumerate(ls)])
    entries = literal(spark, "book string, label string, printed string, deviation string", [(b, *e) for b, _, es, _ in _BOOKS for e in es])
    dropped = literal(spark, "book string, line string", [(b, x) for b, _, _, ds in _BOOKS for x in ds])
    printed, keys = coverage.printed_titles(lines), coverage.label_keys(entries)
    return written(coverage.accounted(printed, keys, dropped), "case-verdicts"), written(coverage.additions(printed, keys), "case-additions")


def coverage_cases(spark, d):
    """Accounting of every stated book, with the lines that nothing explains; books without printed contents don't come out."""
    verdicts, added = _coverage(spark)
    samples = verdicts.where("verdict = 'silent'").groupBy("book").agg(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("line_no", "line"))), 1, 5), lambda x: F.substring(x["line"], 1, 40)), " | ").alias("samples"))
    more = added.groupBy("book").agg(F.count(F.lit(1)).alias("additions"))
    return coverage.by_book(verdicts).join(samples, "book", "left").join(more, "book", "left").select("book", "printed_lines", "restored", "explained", "silent", F.coalesce("additions", F.lit(0)).alias("additions"), "samples")


def coverage_failing(spark, d):
    """Books with silent lines, the most first."""
    return coverage_cases(spark, d).where("silent > 0").orderBy(F.desc("silent"), "book").select("book", "silent", "samples")


def coverage_report_rows(spark, d):
    """One report of measured books and of books that could not be measured: the union of their columns."""
    bad = literal(spark, "book string, error string", [("prose", "no printed contents"), ("torn", "unreadable archive")])
    return coverage_cases(spark, d).unionByName(bad, allowMissingColumns=True)


def coverage_exit_codes(spark, d):
    """The gate's exit code for some sets of books, lax and strict."""
    verdicts, added = _coverage(spark)
    report = coverage.by_book(verdicts)
    sets = {"all": None, "clean": ["whole", "declared", "damaged", "wrapped"], "added": ["added"], "none": ["prose"]}
    rows = []
    for name, books in sets.items():
        r, a = (report, added) if books is None else (report.where(F.col("book").isin(books)), added.where(F.col("book").isin(books)))
        rows += [(name, strict, coverage.gate(r, a, strict)) for strict in (False, True)]
    return literal(spark, "books string, strict boolean, exit_code int", rows)


# --- preflight of a review against the blocks of its book

_FILES = ["one.html", "two.html"]
_BLOCKS = [(f, n, k, f"{n[:-5]} block {k} with Some  Title") for f, n in enumerate(_FILES) for k in range(4)]
_REVIEWS = {
    "sound": [("A", "one.html", 0, "block 0"), ("B", "one.html", 2, "SomeTitle"), ("C", "two.html", 1, "two block 1")],
    "no file": [("A", "gone.html", 0, "x"), ("", "one.html", 9, "")],
    "shared": [("A", "one.html", 1, "block 1"), ("B", "one.html", 1, "block 1")],
    "backwards": [("A", "two.html", 0, "two"), ("B", "one.html", 3, "one")],
    "no label": [("A", "one.html", 0, "one"), ("&nbsp;", "one.html", 1, "one")],
    "outside": [("A", "one.html", 4, "one")],
    "no text": [("A", "one.html", 0, "one"), ("B", "one.html", 1, " ")],
    "stale": [("A", "one.html", 0, "one"), ("B", "one.html", 1, "Old title"), ("C", "gone.html", 0, "x")],
}


def preflight_first_error(spark, d):
    e = literal(spark, "book string, item_no int, label string, file string, block int, expect string", [(b, i, *x) for b, xs in _REVIEWS.items() for i, x in enumerate(xs, 1)])
    b = literal(spark, "book string, file_index int, file string, block int, text string", [(b, *x) for b in _REVIEWS for x in _BLOCKS])
    return edits.preflight(e, b)


def coordinate_join(spark, d):
    """Coordinates of a review with the block that stands there; one that leads nowhere is an error row."""
    e = literal(spark, "book string, item_no int, label string, file string, block int, expect string", [(b, i, *x) for b, xs in _REVIEWS.items() for i, x in enumerate(xs, 1)])
    b = literal(spark, "file_index int, file string, block int, text string", _BLOCKS)
    return e.join(b, ["file", "block"], "left").select("book", "item_no", "file", "block", "text", F.when(F.col("text").isNull(), "no such block").alias("error"))


# --- edits of a small navigation

_NAV = [
    ("n", 1, [0], "Front", "a.html"), ("n", 2, [1], "First", "b.html"), ("n", 3, [1, 0], "Inner", "b.html#i"), ("n", 4, [1, 0, 0], "Innermost", "b.html#m"), ("n", 5, [2], "Second", "c.html"), ("n", 6, [3], "Third", "d.html"),
    ("m", 11, [0], "Same", "a.html"), ("m", 12, [1], "Same", "b.html"), ("m", 13, [2], "Other", "b.html"),
]
_NAV_SCHEMA = "book string, entry_id bigint, path array<int>, label string, src string"


def nav_move_before(spark, d):
    """Two entries moved before another in the order asked for; a book where a label stands twice, or is missing, stays as it is."""
    moves = [("n", 1, "Third", "First"), ("n", 2, "Second", "First"), ("m", 1, "Other", "Same")]
    return edits.moved(literal(spark, _NAV_SCHEMA, _NAV), literal(spark, "book string, ord int, label string, before string", moves))


def nav_relabel_by_target(spark, d):
    """Labels changed by target and old wording; what meets none or several changes nothing."""
    changes = [("n", "b.html#i", "Inner", "Inside"), ("n", "x.html", "First", "Gone"), ("m", "a.html", "Same", "Alike")]
    nav = literal(spark, _NAV_SCHEMA, [*_NAV, ("m", 14, [3], "Twin", "t.html"), ("m", 15, [4], "Twin", "t.html")])
    out, report = edits.relabelled(nav, literal(spark, "book string, src string, old string, new string", [*changes, ("m", "t.html", "Twin", "Single")]))
    changed = out.join(nav.select("entry_id", F.col("label").alias("before")), "entry_id").where("label <> before").select(F.lit("entry").alias("part"), F.col("entry_id").cast("string").alias("key"), F.col("label").alias("value"))
    return changed.unionByName(report.select(F.lit("report").alias("part"), F.col("old").alias("key"), F.col("matches").cast("string").alias("value")))


def nav_delete_named(spark, d):
    """Entries left when some go by label and some by target, with all below them."""
    named = literal(spark, "book string, label string, src string", [("n", "Inner", None), ("n", None, "d.html"), ("m", None, "b.html")])
    return edits.deleted(literal(spark, _NAV_SCHEMA, _NAV), named).select("book", "entry_id", "label")


def nav_prune_guards(spark, d):
    """The same candidates pruned under guards of 1, 2 and 3 remaining entries."""
    nav, out = literal(spark, _NAV_SCHEMA, _NAV), None
    candidates = nav.where(F.col("entry_id").isin(3, 11, 12)).select("entry_id")
    for least in (1, 2, 3):
        one = edits.pruned(nav, candidates, least).groupBy("book").agg(F.count(F.lit(1)).alias("left"), F.max("removed").alias("removed"), F.max("play_order").alias("last")).withColumn("least", F.lit(least))
        out = one if out is None else out.unionByName(one)
    return out


def nav_demote_guard(spark, d):
    """Entries whose label is a printed contents line go, unless none would be left."""
    from folianth.functions import classify

    nav = literal(spark, _NAV_SCHEMA, [*_NAV, ("n", 7, [4], "第三章 涨潮……12", "e.html"), ("p", 21, [0], "第三章 涨潮……12", "a.html"), ("p", 22, [1], "第五章 退潮 …… 30", "b.html")])
    return edits.pruned(nav, nav.where(classify.printed_entry(F.col("label"))).select("entry_id"), 1).select("book", "entry_id", "removed")


def nav_add_edges(spark, d):
    """Entries added at the edges; a label that the book has and a place that is none make errors."""
    added = [("n", 1, "start", "Cover"), ("n", 2, "start", "Half title"), ("n", 3, "end", "Index"), ("n", 4, "end", "  First "), ("m", 1, "middle", "Plate")]
    return edits.edged(literal(spark, _NAV_SCHEMA, _NAV), literal(spark, "book string, ord int, position string, label string", added))


# --- lookups around a place

_PAGES = [
    ("after", "<p>Tides</p> ..... 12 and more", 3, 8), ("before", "<b>17</b> Tides rise", 10, 15), ("near", "Tides<br/>&hellip;&hellip; 9", 0, 5), ("around", "see 8 Reefs and Tides; nothing else", 16, 21), ("plain", "The tides rise and fall twice.", 4, 9), ("escaped", "Tides &#46;&#46;&#46; 7 ", 0, 5),
]


def locator_cases(spark, d):
    """Whether a page locator stands after, before, near or around a match."""
    rows = literal(spark, "name string, text string, start int, stop int", _PAGES)
    t, a, b = F.col("text"), F.col("start"), F.col("stop")
    return rows.select("name", L.locator_after(t, b).alias("after"), L.locator_before(t, a).alias("before"), L.locator_near(t, a, b).alias("near"), L.locator_around(t, a, b).alias("around"))


def offset_cases(spark, d):
    """Where a link's element begins, for an audit and for a repair, and the text around it."""
    page = '<p>One</p><p id="two">Two words</p>'
    rows = literal(spark, "name string, fragment string, label string", [("by id", "two", "x"), ("missing id", "gone", "Two"), ("by label", "", "Two"), ("nothing", "", "Three"), ("no label", "", "")])
    p, f, x = F.lit(page), F.col("fragment"), F.col("label")
    at = L.fragment_offset(p, f, x)
    return rows.select("name", at.alias("audit"), L.fragment_offset(p, f, x, True).alias("repair"), L.snippet(p, at, 3, 12).alias("near"))


def likely_printed_nav(spark, d):
    rows = [("a", "第三章 涨潮……12", 9, ""), ("b", "Front", 1, "书前有目录一页"), ("c", "Front", 3, "目录"), ("d", "Front", 2, "Reefs ..... 4"), ("e", "Plain", 0, "Nothing of the kind")]
    t = literal(spark, "name string, label string, file_index int, near string", rows)
    return t.select("name", L.likely_printed(F.col("label"), F.col("file_index"), F.col("near")).alias("likely"))


def link_cases(spark, d):
    """Links joined to the folder of the file that names them, and cut into file and fragment."""
    rows = literal(spark, "base string, link string", [("OEBPS/nav/toc.ncx", "../text/a%20b.html#x"), ("toc.ncx", "a.html"), ("a/b/c.ncx", "./d/../e.html#p%31"), ("a/t.ncx", "../../up.html"), ("a/t.ncx", "x+y.html#1+1")])
    file, fragment = rules.split_source(F.col("link"))
    return rows.select("link", file.alias("file"), fragment.alias("fragment"), rules.joined_path(F.col("base"), file).alias("joined"))


_DOCS = [("b", 0, "Foreword and thanks"), ("b", 1, "The tides, a chapter"), ("b", 2, "Reefs. The tides again"), ("b", 3, "Index of names")]


def wrapped_searches(spark, d):
    asked = literal(spark, "book string, search_id int, search string, start_index int", [("b", 1, "The Tides".lower(), 2), ("b", 2, "the tides", 3), ("b", 3, "Foreword", 2), ("b", 4, "no such", 0), ("b", 5, "…", 0)])
    return L.wrapped_search(asked, literal(spark, "book string, file_index int, text string", [(b, i, t.lower() if i else t) for b, i, t in _DOCS]))


def body_retargets(spark, d):
    """Titles led from the printed contents to the body: the first later block with the title, and the same with a search that wraps."""
    blocks = [(0, 0, "目录"), (0, 1, "潮汐的成因……4"), (0, 2, "灯塔与海岸……18"), (1, 0, "潮汐的成因"), (1, 1, "说到灯塔 与海岸，先看地图。"), (2, 0, "灯塔与海岸"), (2, 1, "前置的说明在此")]
    titles = [(1, 0, 1, "潮汐的成因……4"), (2, 0, 2, "灯塔与海岸……18"), (3, 2, 1, "潮汐的成因"), (4, 0, 0, "没有的标题")]
    b = literal(spark, "book string, file_index int, block int, text string", [("b", *x) for x in blocks])
    t = literal(spark, "book string, entry_id int, file_index int, block int, label string", [("b", *x) for x in titles])
    one = L.body_targets(t, b).select(F.lit("later").alias("how"), "entry_id", "file_index", "block")
    return one.unionByName(L.body_targets(t, b, wrap=True).select(F.lit("wrapped").alias("how"), "entry_id", "file_index", "block"))


def nth_current_target(spark, d):
    """Entries that take the place of a current entry with their label: the n-th, or the only one."""
    targets = literal(spark, "book string, seq bigint, label string, pos string", [("b", 1, "Part One", "p1"), ("b", 2, "Notes", "p2"), ("b", 3, "Notes", "p3"), ("b", 4, "Part  Two", "p4")])
    wanted = literal(spark, "book string, label string, occurrence int", [("b", "PartOne", None), ("b", "Notes", 2), ("b", "Notes", None), ("b", "Notes", 3), ("b", "Part Two", 1), ("b", "Absent", None)])
    return L.nth_target(wanted, targets)


def group_expand(spark, d):
    """Blocks between two coordinates, ends included, over several files."""
    ranges = literal(spark, "book string, range_id int, start_file int, start_block int, stop_file int, stop_block int", [("b", 1, 0, 2, 1, 1), ("b", 2, 1, 3, 1, 3), ("b", 3, 1, 2, 0, 0)])
    return L.range_expand(ranges.where("start_file <= stop_file"), literal(spark, "book string, file_index int, block int, text string", [("b", f, k, t) for f, _, k, t in _BLOCKS])).select("range_id", "file_index", "block")


def numbered_transcription(spark, d):
    lines = ["1. 潮", "汐", "3. 不算", "2、灯塔 2 座", "于 4 点", "4. 早了", "3．归航"]
    return L.numbered_titles(literal(spark, "book string, seq bigint, text string", [("b", i, x) for i, x in enumerate(lines)])).select("no", "title")


def tree_compare(spark, d):
    """Entries that only one of two trees has; the expected text doesn't count."""
    a = [("b", [0], "A", "x.html", 1), ("b", [1], "B", "x.html", 2), ("b", [1, 0], "C", "y.html", 0)]
    schema = "book string, path array<int>, label string, file string, block int"
    return L.tree_differences(literal(spark, schema, a), literal(spark, schema, [a[0], ("b", [1], "B", "x.html", 3), a[2]])).select("label", "block", "side")


_CHAPTERS = [["目录", "第一讲 潮汐", "第二讲 灯塔"], ["第一讲 潮汐", "海水一日两涨。", "漫长的", "海岸线", "注释"], ["第二讲 灯塔", "灯塔 与 海岸", "注释", "灯塔"]]
#: (number, label, search, exact, occurrence, window, last file, file, block)
_SEARCHES = [
    (1, "第一讲 潮汐", None, True, None, None, None, None, None), (2, "漫长的海岸线", None, True, None, 2, None, None, None), (3, "注释", [], True, None, None, None, None, None), (4, "第二讲　灯塔", None, True, None, None, None, None, None), (5, "灯与岸", ["灯塔", "海岸"], False, None, None, None, None, None),
    (6, "注释", None, True, None, None, 1, None, None), (7, "灯塔", None, None, None, None, None, None, None), (8, "卷首", None, None, None, None, None, 0, 2), (9, "注释", None, True, 2, None, None, None, None), (10, "……", None, None, None, None, None, None, None),
]


def resolve_cases(spark, d):
    """Searches resolved one after another: from the book's first file on, after the hit before, within the last file, over two blocks, the n-th."""
    from folianth.operators import resolve

    e = literal(spark, "book string, entry_id bigint, seq int, label string, search array<string>, exact boolean, occurrence int, start_file int, max_file int, window int, file_index int, block int", [("b", n, n, label, search, exact, occurrence, None, last, window, f, b) for n, label, search, exact, occurrence, window, last, f, b in _SEARCHES])
    blocks = literal(spark, "book string, file_index int, block int, text string", [("b", f, k, t) for f, c in enumerate(_CHAPTERS) for k, t in enumerate(c)])
    out = resolve.resolve(e, blocks, literal(spark, "book string, start_file int, start_block int, exact boolean", [("b", 1, 0, None)]))
    return out.select("entry_id", "file_index", "block", F.when(F.col("error").isNotNull(), "unresolved").alias("error"))


# --- books, specs, notes, reports

_SHELF = ["[reviewed] Tides.epub", "Tides.epub", "Tides of the North.epub", "Reefs (2nd).epub", "Reefs.epub"]


def book_patterns(spark, d):
    wanted = literal(spark, "pattern string", [(x,) for x in ("[reviewed] Tides.epub", "Tides*", "*North*", "Reefs ?2nd?.epub", "*", "Nothing*", "[RT]eefs.epub")])
    return files.find_books(wanted, literal(spark, "book string", [(x,) for x in _SHELF]))


def spec_book_match(spark, d):
    specs = literal(spark, "ord int, file string", [(1, "Tides.epub"), (2, "Tides of the North.epub"), (3, "Reefs (2nd).epub")])
    return L.match_specs(literal(spark, "book string", [(x,) for x in _SHELF]), specs)


def spec_name_checks(spark, d):
    return files.spec_names(literal(spark, "file string", [("a.epub",), ("a.epub",), ("b.epub",), ("",), (None,)]))


_NOTES = [(1, "Tides", "printed contents are broad"), (2, "North", "never reached"), (3, "Reefs (", "second edition")]


def review_ledger(spark, d):
    """The ledger of a review: summary and audit of each book joined by name, decision by whether a backup exists, the first note that fits."""
    summary = literal(spark, "name string, nav_items int, toc_windows int", [(x, 10 + i, i % 2) for i, x in enumerate(_SHELF)])
    audit = literal(spark, "name string, order_inversions int, missing_targets int", [(x, 0, i % 2) for i, x in enumerate(_SHELF[:4])])
    backups = literal(spark, "name string", [("Tides.epub",), ("Reefs.epub",)]).withColumn("rebuilt", F.lit(True))
    rows = summary.join(audit, "name", "left").join(backups, "name", "left").join(L.first_holder(summary.select("name"), literal(spark, "ord int, marker string, note string", _NOTES)), "name")
    return rows.select("name", F.when(F.col("rebuilt"), "rebuilt").otherwise("no change").alias("decision"), "nav_items", "toc_windows", "order_inversions", "missing_targets", F.coalesce("note", F.lit("reviewed")).alias("note"), F.when(F.col("order_inversions").isNull(), "no audit").alias("error"))


def csv_round_trip(spark, d):
    """A report with a byte-order mark, written and read again."""
    path = f"{shared_dir(spark).removeprefix('file://').rstrip('/')}/report-{uuid.uuid4().hex[:8]}"
    os.makedirs(path, exist_ok=True)
    rows = literal(spark, "book string, note string, n int", [("潮汐", 'says "no", twice', 1), ("Reefs", "two\nlines", 2), ("x", None, 3)])
    files.write_report(rows.orderBy("n"), f"{path}/r.csv")
    return files.read_csv(spark, f"file://{path}/r.csv").select("book", "note", "n")


def layout_files(spark, d):
    """Layout files of several parts: their items in order, and the one that holds no list."""
    path = f"{shared_dir(spark).removeprefix('file://').rstrip('/')}/layout-{uuid.uuid4().hex[:8]}"
    for name, text in (("part-1", '[[{"type":"text","text":"a"},3],[{"type":"text","text":"b"}]]'), ("part-2", '﻿[{"type":"title"}, null]'), ("part-3", '{"type":"text"}')):
        os.makedirs(f"{path}/{name}", exist_ok=True)
        with open(f"{path}/{name}/x_content_list_v2.json", "w", encoding="utf-8") as f:
            f.write(text)
    return files.read_layout(spark, f"file://{path}").select("part", "prefix", F.get_json_object("item", "$.type").alias("type"), F.get_json_object("item", "$.text").alias("text"), "error")


def frozen_specs(spark, d):
    """A reviewed tree as spec text, by its parts: how many entries stand at the top, the label of the first entry below the second."""
    nav = literal(spark, "book string, path array<int>, label string, file string, block int, expect string", [("b", [0], "A", "x.html", 1, "a"), ("b", [1], "B", "x.html", 2, None), ("b", [1, 0], "C", "y.html", 0, "c"), ("b", [3, 1], "Loose", "y.html", 3, "l")])
    s = files.book_json(nav)
    return s.select("book", F.json_array_length(F.get_json_object("spec", "$.entries")).alias("top"), F.get_json_object("spec", "$.entries[1].children[0].label").alias("inner"), F.get_json_object("spec", "$.entries[1].expect").alias("expect"), F.get_json_object("spec", "$.entries[2].label").alias("loose"))


# --- layout items

_ITEMS = [
    '{"type":"text","text":"第二章 潮水涨落 12","text_level":1}', '{"type":"title","content":{"title_content":[{"content":"第二节 灯塔"}]}}', '{"type":"title","content":"没有级别"}', '{"type":"header","text":"no"}', '{"type":"paragraph","content":{"paragraph_content":[{"type":"text","content":"x is "},{"type":"equation_inline","content":"\\\\alpha_{1}"}]}}',
    '{"type":"table","content":{"html":"<table><tr><td>$x^2$</td></tr></table>","table_caption":["Cap"],"table_footnote":["Note"]}}', '{"type":"image","content":{"image_source":{"path":"a/b.png"},"image_caption":["A [lamp]"]}}', '{"type":"image","img_path":"b.txt"}', '{"type":"equation_interline","content":{"math_content":"a \\\\leq b"}}',
    '{"type":"list","content":{"list_items":[{"item_content":[{"type":"text","content":"one"}],"sub":{"list_items":[{"item_content":"inner"}]}},{"item_content":"two"}]}}', '{"type":"code","content":{"code_content":"a\\n  b","code_language":"py","code_caption":["run"]}}', '{"type":"page_footnote","content":{"page_footnote_content":"fine print"}}', '{"type":"odd","content":{"style":"kept","sub":"too"}}', '{"type":"text"}', "{", None,
]


def markdown_cases(spark, d):
    """Stated layout items in the plain and in the rich form."""
    rows = literal(spark, "book string, seq int, block_id bigint, type string, item string", [("b", i, i, None if x is None or x == "{" else x.split('"')[3], x) for i, x in enumerate(_ITEMS)]).fillna("text", ["type"])
    a = layout.rendered(rows).select(F.lit("plain").alias("form"), "seq", "markdown")
    return a.unionByName(layout.rich(rows).select(F.lit("rich").alias("form"), "seq", "markdown"))


_MATH = '<span class="math-inline">{}</span>'
SQL = {
    "coverage_cases": values_sql("book VARCHAR, printed_lines BIGINT, restored BIGINT, explained BIGINT, silent BIGINT, additions BIGINT, samples VARCHAR", [
        ("whole", 5, 5, 0, 0, 0, None), ("declared", 5, 3, 2, 0, 0, None), ("silent", 5, 3, 1, 1, 0, "谢词"), ("added", 5, 3, 2, 0, 1, None), ("damaged", 5, 5, 0, 0, 0, None), ("undeclared", 5, 4, 0, 1, 0, "第三讲 归舫"), ("wrapped", 5, 5, 0, 0, 0, None),
    ]),
    "coverage_failing": values_sql("book VARCHAR, silent BIGINT, samples VARCHAR", [("silent", 1, "谢词"), ("undeclared", 1, "第三讲 归舫")]),
    "coverage_exit_codes": values_sql("books VARCHAR, strict BOOLEAN, exit_code INTEGER", [("all", False, 3), ("all", True, 4), ("clean", False, 0), ("clean", True, 0), ("added", False, 0), ("added", True, 4), ("none", False, 2), ("none", True, 2)]),
    "preflight_first_error": values_sql("book VARCHAR, item_no INTEGER, error VARCHAR", [("no file", 1, "missing spine file"), ("shared", 2, "shared target block"), ("backwards", 2, "not in body reading order"), ("no label", 2, "empty label"), ("outside", 1, "block outside the file"), ("no text", 2, "no expected text"), ("stale", 2, "stale expected text")]),
    "coordinate_join": f"SELECT e.book, e.item_no, e.file, e.block, b.text, CASE WHEN b.text IS NULL THEN 'no such block' END AS error FROM ({values_sql('book VARCHAR, item_no INTEGER, file VARCHAR, block INTEGER', [(b, i, x[1], x[2]) for b, xs in _REVIEWS.items() for i, x in enumerate(xs, 1)])}) e LEFT JOIN ({values_sql('file VARCHAR, block INTEGER, text VARCHAR', [x[1:] for x in _BLOCKS])}) b ON e.file = b.file AND e.block = b.block",
    "nav_move_before": values_sql("book VARCHAR, entry_id BIGINT, label VARCHAR, play_order BIGINT, error VARCHAR", [
        ("n", 1, "Front", 1, None), ("n", 6, "Third", 2, None), ("n", 5, "Second", 3, None), ("n", 2, "First", 4, None), ("n", 3, "Inner", 5, None), ("n", 4, "Innermost", 6, None), ("m", 11, "Same", 1, "label not unique"), ("m", 12, "Same", 2, "label not unique"), ("m", 13, "Other", 3, "label not unique"),
    ]),
    "nav_relabel_by_target": values_sql("part VARCHAR, key VARCHAR, value VARCHAR", [("entry", "3", "Inside"), ("entry", "11", "Alike"), ("report", "Inner", "1"), ("report", "First", "0"), ("report", "Same", "1"), ("report", "Twin", "2")]),
    "nav_delete_named": values_sql("book VARCHAR, entry_id BIGINT, label VARCHAR", [("n", 1, "Front"), ("n", 2, "First"), ("n", 5, "Second"), ("m", 11, "Same")]),
    "nav_prune_guards": values_sql("book VARCHAR, left BIGINT, removed BIGINT, last BIGINT, least INTEGER".replace("left", "\"left\""), [("n", 4, 2, 4, 1), ("m", 1, 2, 1, 1), ("n", 4, 2, 4, 2), ("m", 3, 0, 3, 2), ("n", 4, 2, 4, 3), ("m", 3, 0, 3, 3)]),
    "nav_demote_guard": values_sql("book VARCHAR, entry_id BIGINT, removed BIGINT", [*(("n", i, 1) for i in range(1, 7)), *(("m", i, 0) for i in (11, 12, 13)), ("p", 21, 0), ("p", 22, 0)]),
    "nav_add_edges": values_sql("book VARCHAR, label VARCHAR, play_order BIGINT, error VARCHAR", [
        ("n", "Cover", 1, None), ("n", "Half title", 2, None), ("n", "Front", 3, None), ("n", "First", 4, None), ("n", "Inner", 5, None), ("n", "Innermost", 6, None), ("n", "Second", 7, None), ("n", "Third", 8, None), ("n", "Index", 9, None), ("n", "  First ", None, "label exists"),
        ("m", "Same", 1, None), ("m", "Same", 2, None), ("m", "Other", 3, None), ("m", "Plate", None, "invalid position"),
    ]),
    "locator_cases": values_sql("name VARCHAR, after BOOLEAN, before BOOLEAN, near BOOLEAN, around BOOLEAN", [("after", True, False, True, True), ("before", False, True, False, True), ("near", True, False, True, True), ("around", False, False, False, True), ("plain", False, False, False, False), ("escaped", True, False, True, True)]),
    "offset_cases": values_sql("name VARCHAR, audit INTEGER, repair INTEGER, near VARCHAR", [("by id", 13, 13, "Two"), ("missing id", -1, 4, "One <p"), ("by label", 4, 4, "p>One <p id="), ("nothing", 0, 0, "One <p"), ("no label", 0, 0, "One <p")]),
    "likely_printed_nav": values_sql("name VARCHAR, likely BOOLEAN", [("a", True), ("b", True), ("c", False), ("d", True), ("e", False)]),
    "link_cases": values_sql("link VARCHAR, file VARCHAR, fragment VARCHAR, joined VARCHAR", [("../text/a%20b.html#x", "../text/a b.html", "x", "OEBPS/text/a b.html"), ("a.html", "a.html", "", "a.html"), ("./d/../e.html#p%31", "./d/../e.html", "p1", "a/b/e.html"), ("../../up.html", "../../up.html", "", "../up.html"), ("x+y.html#1+1", "x+y.html", "1+1", "a/x+y.html")]),
    "wrapped_searches": values_sql("book VARCHAR, search_id INTEGER, file_index INTEGER, error VARCHAR", [("b", 1, 2, None), ("b", 2, 1, None), ("b", 3, 0, None), ("b", 4, None, "not found"), ("b", 5, None, "not found")]),
    "body_retargets": values_sql("how VARCHAR, entry_id INTEGER, file_index INTEGER, block INTEGER", [("later", 1, 1, 0), ("later", 2, 1, 1), ("wrapped", 1, 1, 0), ("wrapped", 2, 1, 1), ("wrapped", 3, 1, 0)]),
    "nth_current_target": values_sql("book VARCHAR, label VARCHAR, occurrence INTEGER, pos VARCHAR, error VARCHAR", [("b", "PartOne", None, "p1", None), ("b", "Notes", 2, "p3", None), ("b", "Notes", None, None, "ambiguous label"), ("b", "Notes", 3, None, "no such occurrence"), ("b", "Part Two", 1, "p4", None), ("b", "Absent", None, None, "no such label")]),
    "group_expand": values_sql("range_id INTEGER, file_index INTEGER, block INTEGER", [(1, 0, 2), (1, 0, 3), (1, 1, 0), (1, 1, 1), (2, 1, 3)]),
    "numbered_transcription": values_sql("no INTEGER, title VARCHAR", [(1, "潮汐3. 不算"), (2, "灯塔 2 座于 4 点4. 早了"), (3, "归航")]),
    "resolve_cases": values_sql("entry_id BIGINT, file_index INTEGER, block INTEGER, error VARCHAR", [(1, 1, 0, None), (2, 1, 2, None), (3, 1, 4, None), (4, 2, 0, None), (5, 2, 1, None), (6, None, None, "unresolved"), (7, 2, 3, None), (8, 0, 2, None), (9, 2, 2, None), (10, None, None, "unresolved")]),
    "tree_compare": values_sql("label VARCHAR, block INTEGER, side VARCHAR", [("B", 2, "left"), ("B", 3, "right")]),
    "book_patterns": values_sql("pattern VARCHAR, book VARCHAR, matches BIGINT", [("[reviewed] Tides.epub", "[reviewed] Tides.epub", 1), ("Tides*", None, 2), ("*North*", "Tides of the North.epub", 1), ("Reefs ?2nd?.epub", "Reefs (2nd).epub", 1), ("*", None, 5), ("Nothing*", None, 0), ("[RT]eefs.epub", "Reefs.epub", 1)]),
    "spec_book_match": values_sql("book VARCHAR, spec VARCHAR", [("[reviewed] Tides.epub", "Tides.epub"), ("Tides.epub", "Tides.epub"), ("Tides of the North.epub", "Tides.epub"), ("Reefs (2nd).epub", "Reefs (2nd).epub"), ("Reefs.epub", None)]),
    "spec_name_checks": values_sql("file VARCHAR, n BIGINT, error VARCHAR", [("a.epub", 2, "file name not unique"), ("b.epub", 1, None), ("", 1, "empty file name"), (None, 1, "empty file name")]),
    "review_ledger": values_sql("name VARCHAR, decision VARCHAR, nav_items INTEGER, toc_windows INTEGER, order_inversions INTEGER, missing_targets INTEGER, note VARCHAR, error VARCHAR", [
        ("[reviewed] Tides.epub", "no change", 10, 0, 0, 0, "printed contents are broad", None), ("Tides.epub", "rebuilt", 11, 1, 0, 1, "printed contents are broad", None), ("Tides of the North.epub", "no change", 12, 0, 0, 0, "printed contents are broad", None), ("Reefs (2nd).epub", "no change", 13, 1, 0, 1, "second edition", None), ("Reefs.epub", "rebuilt", 14, 0, None, None, "reviewed", "no audit"),
    ]),
    "csv_round_trip": values_sql("book VARCHAR, note VARCHAR, n VARCHAR", [("潮汐", 'says "no", twice', "1"), ("Reefs", "two\nlines", "2"), ("x", None, "3")]),
    "layout_files": values_sql("part INTEGER, prefix VARCHAR, type VARCHAR, text VARCHAR, error VARCHAR", [(1, "p001", "text", "a", None), (1, "p001", "text", "b", None), (2, "p002", "title", None, None), (3, "p003", None, None, "not a list of items")]),
    "frozen_specs": values_sql("book VARCHAR, top INTEGER, inner_ VARCHAR, expect VARCHAR, loose VARCHAR".replace("inner_", "\"inner\""), [("b", 3, "C", "", "Loose")]),
    "markdown_cases": values_sql("form VARCHAR, seq INTEGER, markdown VARCHAR", [
        ("plain", 0, "第二章 潮水涨落"), ("plain", 1, "## 第二节 灯塔"), ("plain", 2, "**没有级别**"), ("plain", 4, "x is\\alpha_{1}"), ("plain", 5, "<table><tr><td>$x^2$</td></tr></table>\n\n*Cap*\n\n> Note"), ("plain", 6, "![A lamp](a/b.png)\n\n*A [lamp]*"), ("plain", 8, "a \\leq b"), ("plain", 9, "- one\n  - inner\n- two"), ("plain", 10, "*run*\n\n```py\na\n  b\n```"), ("plain", 11, "> fine print"), ("plain", 12, "kept too"),
        ("rich", 1, "# 第二节 灯塔"), ("rich", 2, "# 没有级别"), ("rich", 4, "x is" + _MATH.format("α<sub>1</sub>")), ("rich", 5, "*Cap*\n\n<div class=\"recognized-table\">\n<table><tr><td>" + _MATH.format("x<sup>2</sup>") + "</td></tr></table>\n</div>\n\n> Note"), ("rich", 6, "*A [lamp]*\n\n<div class=\"figure-image\"><img src=\"assets/b.png\" alt=\"A [lamp]\" /></div>"), ("rich", 8, "$$\na \\leq b\n$$\n\n<div class=\"latex-source\">a \\leq b</div>"), ("rich", 9, "- one\n- two"), ("rich", 10, "a\nb py run"), ("rich", 11, "> fine print"), ("rich", 12, "kept too"),
    ]),
}
SQL["coverage_report_rows"] = SQL["coverage_cases"].replace("SELECT ", "SELECT CAST(NULL AS VARCHAR) AS error, ", 1) + " UNION ALL BY NAME SELECT 'prose' AS book, 'no printed contents' AS error UNION ALL BY NAME SELECT 'torn' AS book, 'unreadable archive' AS error"
QUERIES = {k: globals()[k] for k in SQL}
