"""Queries on e-book archives: a shelf of invented books, written as archives, scanned again and read back.

The SQL twins know nothing of archives: they state what must come out, by hand, or work on the same member texts as literal rows.
"""

from __future__ import annotations

import io
import uuid
import zipfile

from pyspark.sql import functions as F

from folianth.operators import provenance, resolve
from folianth.plans.relations import literal, values_sql
from folianth.sources import epub as E
from folianth.sources.tables import shared_dir, ship

_OPF = '<package xmlns="http://www.idpf.org/2007/opf"><manifest>{}</manifest><spine{}>{}</spine></package>'
_NCX = '<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/"><docTitle><text>Shelf</text></docTitle><navMap>{}</navMap></ncx>'


def _item(i, href, kind):
    return f'<item id="{i}" href="{href}" media-type="{kind}"/>'


def _point(order, label, src, below=""):
    return f'<navPoint playOrder="{order}"><navLabel><text>{label}</text></navLabel><content src="{src}"/>{below}</navPoint>'


_HTML, _NAV = "application/xhtml+xml", "application/x-dtbncx+xml"
#: (book, number, member, text): a sound book with folders and a nested navigation; one without a container, with a page that isn't there,
#: an id that stands twice, links that lead out and numbers that aren't; loose pages without a package; a wrong kind of archive.
MEMBERS = [
    ("harbour.epub", 0, "mimetype", "application/epub+zip"), ("harbour.epub", 1, "META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="content/package.opf"/></rootfiles></container>'),
    ("harbour.epub", 2, "content/package.opf", _OPF.format(_item("nav", "toc/nav.ncx", _NAV) + _item("cover", "pages/titlepage.xhtml", _HTML) + _item("one", "pages/quay.xhtml", _HTML) + _item("two", "pages/rope%20walk.xhtml", _HTML) + _item("pic", "art/lamp.png", "image/png"), ' toc="nav"', '<itemref idref="cover"/><itemref idref="one"/><itemref idref="two"/>')),
    ("harbour.epub", 3, "content/toc/nav.ncx", _NCX.format(_point(1, "The quay", "../pages/quay.xhtml#q", _point(2, "Lamps", "../pages/quay.xhtml#lamps")) + _point(3, "Rope walk", "../pages/rope%20walk.xhtml"))),
    ("harbour.epub", 4, "content/pages/titlepage.xhtml", "<p>Harbour Tales</p>"), ("harbour.epub", 5, "content/pages/quay.xhtml", '<h1 id="q">The quay</h1><p>Ships &amp; sails.夜里灯亮。人走了。</p><a id="lamps"></a><p>Lamps burn.</p><img src="../art/lamp.png"/><img src="lamp.png"/><img src="content/art/lamp.png"/>'),
    ("harbour.epub", 6, "content/pages/rope walk.xhtml", "<h2>Rope walk</h2><ul><li><p>Hemp</p></li><li>Tar</li></ul>"), ("harbour.epub", 7, "content/art/lamp.png", "not really a picture"),
    ("orchard.epub", 0, "mimetype", "application/epub+zip"), ("orchard.epub", 1, "book.opf", _OPF.format(_item("a", "a.html", "text/html") + _item("n", "n.ncx", _NAV) + _item("g", "gone.html", "text/html"), "", '<itemref idref="a"/><itemref idref="g"/><itemref idref="nobody"/>')),
    ("orchard.epub", 2, "a.html", '<h1 id="s">Same</h1><p id="s">Same</p><p>Plums'), ("orchard.epub", 3, "n.ncx", _NCX.format(_point(1, "Same", "a.html#s") + _point("x", "Gone", "gone.html") + _point(7, "Out", "../../x.html"))), ("orchard.epub", 4, "z.ncx", _NCX.format("")),
    ("mill.epub", 0, "titlepage.html", "<p>Mill</p>"), ("mill.epub", 1, "page2.html", "<p>second</p>"), ("mill.epub", 2, "page10.html", "<p>tenth</p>"), ("mill.epub", 3, "mimetype", "application/epub+zip"),
    ("punt.epub", 0, "mimetype", "text/plain"),
]
MEMBERS_SQL = f"members AS ({values_sql('book VARCHAR, ordinal INTEGER, member VARCHAR, text VARCHAR', MEMBERS)})"


def archives(spark):
    """(book, content) of the shelf, and a file that is no archive."""
    ship(spark)
    made = {}
    for book, n, member, text in MEMBERS:
        z = made.setdefault(book, io.BytesIO())
        with zipfile.ZipFile(z, "a", zipfile.ZIP_DEFLATED) as f:
            f.writestr(zipfile.ZipInfo(member), text, zipfile.ZIP_STORED if n == 0 and member == "mimetype" else zipfile.ZIP_DEFLATED)
    rows = [(b, bytearray(z.getvalue())) for b, z in made.items()] + [("ferry.epub", bytearray(b"no archive at all"))]
    return spark.createDataFrame(rows, "book string, content binary").repartition(4)


def archive_members(spark, d):
    """The shelf published to the shared folder, found there by a scan, and taken apart."""
    folder = f"{shared_dir(spark).rstrip('/')}/shelf-{uuid.uuid4().hex[:8]}"
    E.verified_copies(archives(spark), folder, f"{folder}-old").collect()
    m = E.members(E.scan_books(spark, folder))
    return m.select("book", "ordinal", "member", "crc_ok", F.length("content").alias("size"), F.split_part("error", F.lit(":"), F.lit(1)).alias("error"))


def publish_outcomes(spark, d):
    """The shelf published three times: all new, all kept, one replaced after a copy of the old file."""
    folder = f"{shared_dir(spark).rstrip('/')}/shelf-{uuid.uuid4().hex[:8]}"
    books = archives(spark)
    first = E.verified_copies(books, folder, f"{folder}-old").groupBy("outcome").count().collect()
    changed = books.withColumn("content", F.when(F.col("book") == "ferry.epub", F.lit(b"another")).otherwise(F.col("content")))
    second = [E.verified_copies(x, folder, f"{folder}-old").groupBy("outcome").count().collect() for x in (books, changed)]
    saved = spark.read.format("binaryFile").load(f"{folder}-old").count()
    rows = [(k + 1, r["outcome"], r["count"]) for k, x in enumerate([first, *second]) for r in x] + [(4, "saved", saved)]
    return literal(spark, "round int, outcome string, books bigint", rows)


def package_files(spark, d):
    return E.packages(archives(spark)).withColumnRenamed("only", "sole")


def spine_variants(spark, d):
    return E.spines(archives(spark))


def _spine(spark, variant="all"):
    return E.spines(archives(spark)).where(F.col("variant") == variant).drop("variant")


def manifest_join(spark, d):
    """The reading order with the file of each reference, null where the manifest has none."""
    books = archives(spark)
    return E.item_refs(books).join(E.manifests(books), ["book", "item_id"], "left").select("book", "ref_no", "item_id", "file_name", "media_type")


def block_scan(spark, d):
    return E.blocks(archives(spark)).select("book", "file_index", "block_index", "tag", "text")


def page_lines(spark, d):
    return E.page_lines(E.members(archives(spark)), _spine(spark)).select("book", "file_index", "line_no", "line")


def html_name_order(spark, d):
    return E.name_order(E.members(archives(spark)))


def nav_scan(spark, d):
    return E.navigation(archives(spark)).select("book", "item_no", "parent_no", "depth", "label", "src", "file_name", "fragment", F.split_part("error", F.lit(":"), F.lit(1)).alias("error"))


def nav_play_order(spark, d):
    """Entries whose stated number is no number, or isn't their place."""
    n = F.col("play_order").try_cast("int")
    rows = E.navigation(archives(spark)).select("book", "item_no", "play_order", F.when(n.isNull(), "invalid play order").when(n != F.col("item_no"), "not its place").alias("error"))
    return rows.where(F.col("error").isNotNull())


def anchor_asof(spark, d):
    """The block that each entry leads to: the element itself, the enclosing block, else the next one."""
    books = archives(spark)
    return E.anchor_targets(E.navigation(books), E.blocks(books))


def archive_findings(spark, d):
    books = archives(spark)
    m = E.members(books)
    a = E.archive_findings(m).select("book", F.split_part("code", F.lit(":"), F.lit(1)).alias("code"), F.lit(None).cast("string").alias("file_name"))
    return a.unionByName(E.missing_members(m, E.manifests(books), _spine(spark, "none")))


def image_ref_audit(spark, d):
    return E.image_refs(E.members(archives(spark)))


def archive_quality(spark, d):
    """Figures of every archive: pages, pictures, references and broken ones, characters, headings, entries, whether it could be read."""
    books = archives(spark)
    m = E.members(books)
    ends = lambda *x: F.lower("member").rlike(rf"\.(?:{'|'.join(x)})$")
    files = m.groupBy("book").agg(F.count_if(ends("html", "xhtml", "htm")).alias("html_files"), F.count_if(ends("png", "jpe?g", "gif", "svg", "webp", "bmp", "avif", "apng", "tiff?")).alias("images"), F.count("error").alias("parse_errors"))
    refs = E.image_refs(m).groupBy("book").agg(F.count(F.lit(1)).alias("image_refs"), F.count_if("broken").alias("broken_refs"))
    text = E.page_lines(m, _spine(spark)).groupBy("book").agg(F.sum(F.length("line")).alias("chars"))
    heads = E.blocks(books).groupBy("book").agg(F.count_if(F.col("tag").rlike("^h[1-6]$")).alias("headings"))
    nav = E.navigation(books).groupBy("book").agg(F.count(F.lit(1)).alias("nav_items"))
    for side in (refs, text, heads, nav):
        files = files.join(side, "book", "left")
    return files.select("book", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("html_files", "images", "image_refs", "broken_refs", "chars", "headings", "nav_items", "parse_errors")))


def manual_apply(spark, d):
    """Two titles looked for in the text, anchored at their blocks, written into the archive and read back."""
    books = archives(spark).where("book = 'harbour.epub'")
    blocks = E.blocks(books)
    asked = [("harbour.epub", 1, 1, "Ships", ["Ships & sails"], False), ("harbour.epub", 2, 2, "Burning lamps", ["Lamps burn."], True), ("harbour.epub", 3, 3, "Tar", None, True), ("harbour.epub", 4, 4, "Nowhere", ["no such text"], False)]
    e = literal(spark, "book string, entry_id bigint, seq int, label string, search array<string>, exact boolean", asked)
    e = e.withColumns({c: F.lit(None).cast("int") for c in ("occurrence", "start_file", "max_file", "window", "file_index", "block")})
    found = resolve.resolve(e, blocks.select("book", "file_index", F.col("block_index").alias("block"), "text")).where(F.col("error").isNull())
    files = blocks.select("book", "file_index", "file_name").distinct()
    placed = found.join(files, ["book", "file_index"]).join(e.select("entry_id", "label"), "entry_id").select("book", F.col("seq").alias("item_no"), "label", F.when(F.col("seq") == 2, 2).otherwise(1).alias("depth"), "file_name", "block")
    once = E.applied(books, placed)
    again = E.applied(once, placed)  # anchors of the run before go
    return E.navigation(again).join(E.anchor_targets(E.navigation(again), E.blocks(again)).drop("error"), ["book", "item_no"]).select("item_no", "depth", "label", "src", "file_index", "block_index")


_WORK = [
    ("same", "a1", "a1", "vlm-engine", {"x.json": "1", "y.md": "2"}, {"x.json": "1", "y.md": "2"}), ("moved", "a1", "a1", "vlm-engine", {"x.json": "1"}, {"x.json": "1"}), ("other source", "b2", "a1", "vlm-engine", {"x.json": "1"}, {"x.json": "1"}), ("kept changed", "a1", "zz", "vlm-engine", {"x.json": "1"}, {"x.json": "1"}),
    ("other backend", "a1", "a1", "pipeline", {"x.json": "1"}, {"x.json": "1"}), ("file changed", "a1", "a1", "vlm-engine", {"x.json": "1"}, {"x.json": "9"}), ("file gone", "a1", "a1", "vlm-engine", {"x.json": "1", "y.md": "2"}, {"x.json": "1"}), ("file added", "a1", "a1", "vlm-engine", {"x.json": "1"}, {"x.json": "1", "n": "3"}),
    ("no files", "a1", "a1", "vlm-engine", {}, {}), ("changed while read", "a1", "b2", "vlm-engine", {"x.json": "1"}, {"x.json": "1"}),
]


def _config(backend):
    return provenance.config(backend, F.lit("auto"), F.lit("ch"), F.lit("hub"), F.lit("2.1"))


def extraction_records(spark, d):
    """What may be recorded of each extraction: the record's version and source, or why not."""
    rows = literal(spark, "book string, source_sha256 string, kept_sha256 string, backend string, files map<string,string>, now map<string,string>", _WORK)
    r = provenance.recorded(rows.select("book", F.concat(F.lit("/in/"), "book").alias("source_path"), "source_sha256", "kept_sha256", _config(F.col("backend")).alias("config"), "files", F.lit("2026-01-01T00:00:00+00:00").alias("finished_at")))
    return r.select("book", F.get_json_object("record", "$.version").alias("version"), F.get_json_object("record", "$.source_sha256").alias("source"), F.get_json_object("record", "$.extraction_config.method").alias("method"), "error")


def extraction_verdicts(spark, d):
    """Whether each kept extraction may be used again; all were recorded from source a1 by the same engine."""
    rows = literal(spark, "book string, source_sha256 string, kept_sha256 string, backend string, files map<string,string>, now map<string,string>", _WORK)
    record = provenance.recorded(rows.select("book", F.lit("/in").alias("source_path"), F.lit("a1").alias("source_sha256"), F.lit("a1").alias("kept_sha256"), _config(F.lit("vlm-engine")).alias("config"), "files", F.lit("t").alias("finished_at"))).select("book", "record")
    work = rows.join(record, "book").select("book", "record", "source_sha256", "kept_sha256", _config(F.col("backend")).alias("config"), F.col("now").alias("files"))
    return provenance.verify_extractions(work)


def config_identity(spark, d):
    """Which settings make an extraction another one, by engine."""
    rows = literal(spark, "backend string, method string, lang string", [("vlm-engine", "auto", "ch"), ("vlm-engine", "ocr", "en"), ("pipeline", "auto", "ch"), ("pipeline", "auto", "en"), ("pipeline", "ocr", "ch"), ("hybrid", "auto", "en")])
    c = provenance.config(F.col("backend"), F.col("method"), F.col("lang"), F.lit("hub"), F.lit("2.1"))
    return rows.select("backend", "method", "lang", c.alias("c")).select("backend", "method", "lang", F.col("c.method").alias("kept_method"), F.col("c.lang").alias("kept_lang"))


_OUTPUTS = [("sound", "/Out/A.epub", "h1", "s", "c"), ("sound", "/out/a.azw3", "h2", "s", "c"), ("other settings", "/out/a.epub", "h1", "s", "d"), ("stale", "/out/a.epub", "h0", "s", "c"), ("half", "/out/a.epub", "h1", "s", "c"), ("half", "/out/b.epub", "h1", "s", "c")]
_RECEIPTS = ['{"conversion_provenance":{"version":1,"source_sha256":"s","build_config":"c"},"artifacts":[{"canonical":"/out/a.epub","sha256":"h1"},{"canonical":"/out/a.AZW3","sha256":"h2"}]}', "{broken", '{"conversion_provenance":{"version":2,"source_sha256":"s","build_config":"d"},"artifacts":[{"canonical":"/out/a.epub","sha256":"h1"}]}', None]


def receipt_attestation(spark, d):
    outs = literal(spark, "book string, path string, sha256 string, source_sha256 string, build_config string", _OUTPUTS)
    return provenance.attested(outs, literal(spark, "body string", [(r,) for r in _RECEIPTS]))


def azw3_headers(spark, d):
    rows = literal(spark, "name string, content binary", [("good", bytearray(b"x" * 60 + b"BOOKMOBI" + b"x" * 40)), ("short", bytearray(b"x" * 60 + b"BOOKMOBI")), ("wrong", bytearray(b"wrong" * 40))])
    return rows.select("name", provenance.azw3_error(F.col("content")).alias("error"))


_Q, _R, _T = "content/pages/quay.xhtml", "content/pages/rope walk.xhtml", "content/pages/titlepage.xhtml"
SQL = {
    "archive_members": f"WITH {MEMBERS_SQL} SELECT book, ordinal, member, true AS crc_ok, CAST(strlen(text) AS INTEGER) AS size, CAST(NULL AS VARCHAR) AS error FROM members UNION ALL SELECT 'ferry.epub', -1, NULL, NULL, NULL, 'unreadable archive'",
    "publish_outcomes": values_sql("round INTEGER, outcome VARCHAR, books BIGINT", [(1, "new", 5), (2, "kept", 5), (3, "kept", 4), (3, "replaced", 1), (4, "saved", 1)]),
    "package_files": values_sql("book VARCHAR, package VARCHAR, strict VARCHAR, first VARCHAR, sole VARCHAR", [("harbour.epub", "content/package.opf", *["content/toc/nav.ncx"] * 3), ("orchard.epub", "book.opf", "n.ncx", "n.ncx", None), *((b, None, None, None, None) for b in ("mill.epub", "punt.epub", "ferry.epub"))]),
    "spine_variants": values_sql("book VARCHAR, variant VARCHAR, file_index INTEGER, file_name VARCHAR", [
        *(("harbour.epub", v, i, n) for v in ("all", "no_titlepage", "none") for i, n in enumerate((_T, _Q, _R))), *(("orchard.epub", v, i, n) for v in ("all", "no_titlepage", "none") for i, n in enumerate(("a.html", "gone.html"))),
        ("mill.epub", "all", 0, "titlepage.html"), ("mill.epub", "all", 1, "page2.html"), ("mill.epub", "all", 2, "page10.html"), ("mill.epub", "no_titlepage", 0, "page2.html"), ("mill.epub", "no_titlepage", 1, "page10.html"),
    ]),
    "manifest_join": values_sql("book VARCHAR, ref_no INTEGER, item_id VARCHAR, file_name VARCHAR, media_type VARCHAR", [("harbour.epub", 0, "cover", _T, _HTML), ("harbour.epub", 1, "one", _Q, _HTML), ("harbour.epub", 2, "two", _R, _HTML), ("orchard.epub", 0, "a", "a.html", "text/html"), ("orchard.epub", 1, "g", "gone.html", "text/html"), ("orchard.epub", 2, "nobody", None, None)]),
    "block_scan": values_sql("book VARCHAR, file_index INTEGER, block_index INTEGER, tag VARCHAR, text VARCHAR", [
        ("harbour.epub", 0, 0, "p", "Harbour Tales"), ("harbour.epub", 1, 0, "h1", "The quay"), ("harbour.epub", 1, 1, "p", "Ships & sails.夜里灯亮。人走了。"), ("harbour.epub", 1, 2, "p", "Lamps burn."), ("harbour.epub", 2, 0, "h2", "Rope walk"), ("harbour.epub", 2, 1, "li", "Hemp"), ("harbour.epub", 2, 2, "p", "Hemp"), ("harbour.epub", 2, 3, "li", "Tar"),
        ("orchard.epub", 0, 0, "h1", "Same"), ("orchard.epub", 0, 1, "p", "Same"), ("orchard.epub", 0, 2, "p", "Plums"), ("mill.epub", 0, 0, "p", "Mill"), ("mill.epub", 1, 0, "p", "second"), ("mill.epub", 2, 0, "p", "tenth"),
    ]),
    "page_lines": values_sql("book VARCHAR, file_index INTEGER, line_no INTEGER, line VARCHAR", [("harbour.epub", 0, 0, "Harbour Tales"), ("harbour.epub", 1, 0, "The quay Ships & sails.夜里灯亮。"), ("harbour.epub", 1, 1, "人走了。"), ("harbour.epub", 1, 2, "Lamps burn."), ("harbour.epub", 2, 0, "Rope walk Hemp Tar"), ("orchard.epub", 0, 0, "Same Same Plums"), ("mill.epub", 0, 0, "Mill"), ("mill.epub", 1, 0, "second"), ("mill.epub", 2, 0, "tenth")]),
    "html_name_order": f"WITH {MEMBERS_SQL} SELECT book, CAST(row_number() OVER (PARTITION BY book ORDER BY member) - 1 AS INTEGER) AS file_index, member AS file_name FROM members WHERE regexp_matches(member, '\\.x?html?$') AND NOT contains(member, 'titlepage')",
    "nav_scan": values_sql("book VARCHAR, item_no INTEGER, parent_no INTEGER, depth INTEGER, label VARCHAR, src VARCHAR, file_name VARCHAR, fragment VARCHAR, error VARCHAR", [
        ("harbour.epub", 1, None, 1, "The quay", "../pages/quay.xhtml#q", _Q, "q", None), ("harbour.epub", 2, 1, 2, "Lamps", "../pages/quay.xhtml#lamps", _Q, "lamps", None), ("harbour.epub", 3, None, 1, "Rope walk", "../pages/rope%20walk.xhtml", _R, "", None),
        ("orchard.epub", 1, None, 1, "Same", "a.html#s", "a.html", "s", None), ("orchard.epub", 2, None, 1, "Gone", "gone.html", "gone.html", "", None), ("orchard.epub", 3, None, 1, "Out", "../../x.html", None, None, "reference leaves the book"),
    ]),
    "nav_play_order": values_sql("book VARCHAR, item_no INTEGER, play_order VARCHAR, error VARCHAR", [("orchard.epub", 2, "x", "invalid play order"), ("orchard.epub", 3, "7", "not its place")]),
    "anchor_asof": values_sql("book VARCHAR, item_no INTEGER, file_index INTEGER, block_index INTEGER, error VARCHAR", [("harbour.epub", 1, 1, 0, None), ("harbour.epub", 2, 1, 2, None), ("harbour.epub", 3, 2, 0, None), ("orchard.epub", 1, None, None, "fragment has several matches"), ("orchard.epub", 2, None, None, "missing target"), ("orchard.epub", 3, None, None, "missing target")]),
    "archive_findings": values_sql("book VARCHAR, code VARCHAR, file_name VARCHAR", [("mill.epub", "invalid mimetype placement", None), ("punt.epub", "invalid mimetype content", None), ("ferry.epub", "unreadable archive", None), ("orchard.epub", "missing manifest resource", "gone.html"), ("orchard.epub", "missing page", "gone.html"), ("mill.epub", "no page", None), ("punt.epub", "no page", None)]),
    "image_ref_audit": values_sql("book VARCHAR, file_name VARCHAR, ref VARCHAR, broken BOOLEAN", [("harbour.epub", _Q, "../art/lamp.png", True), ("harbour.epub", _Q, "lamp.png", True), ("harbour.epub", _Q, "content/art/lamp.png", False)]),
    "archive_quality": values_sql("book VARCHAR, html_files BIGINT, images BIGINT, image_refs BIGINT, broken_refs BIGINT, chars BIGINT, headings BIGINT, nav_items BIGINT, parse_errors BIGINT", [("harbour.epub", 3, 1, 3, 2, 74, 2, 3, 0), ("orchard.epub", 1, 0, 0, 0, 15, 1, 3, 0), ("mill.epub", 3, 0, 0, 0, 15, 0, 0, 0), ("punt.epub", 0, 0, 0, 0, 0, 0, 0, 0), ("ferry.epub", 0, 0, 0, 0, 0, 0, 0, 1)]),
    "manual_apply": values_sql("item_no INTEGER, depth INTEGER, label VARCHAR, src VARCHAR, file_index INTEGER, block_index INTEGER", [(1, 1, "Ships", "../pages/quay.xhtml#toc_1", 1, 1), (2, 2, "Burning lamps", "../pages/quay.xhtml#toc_2", 1, 2), (3, 1, "Tar", "../pages/rope%20walk.xhtml#toc_3", 2, 3)]),
    "extraction_records": values_sql("book VARCHAR, version VARCHAR, source VARCHAR, method VARCHAR, error VARCHAR", [*((b, "1", "a1", None, None) for b in ("same", "moved", "file changed", "file gone", "file added")), ("other backend", "1", "a1", "auto", None), ("no files", None, None, None, "no files"), *((b, None, None, None, "source changed during extraction") for b in ("other source", "kept changed", "changed while read"))]),
    "extraction_verdicts": values_sql("book VARCHAR, verdict VARCHAR", [("same", None), ("moved", None), ("other source", "different source bytes"), ("kept changed", "kept source was modified"), ("other backend", "configuration changed"), ("file changed", "files changed or incomplete"), ("file gone", "files changed or incomplete"), ("file added", "files changed or incomplete"), ("no files", "no provenance"), ("changed while read", "kept source was modified")]),
    "config_identity": "SELECT backend, method, lang, CASE WHEN backend <> 'vlm-engine' THEN method END AS kept_method, CASE WHEN backend = 'pipeline' THEN lang END AS kept_lang FROM (VALUES ('vlm-engine', 'auto', 'ch'), ('vlm-engine', 'ocr', 'en'), ('pipeline', 'auto', 'ch'), ('pipeline', 'auto', 'en'), ('pipeline', 'ocr', 'ch'), ('hybrid', 'auto', 'en')) t(backend, method, lang)",
    "receipt_attestation": values_sql("book VARCHAR, attested BOOLEAN", [("sound", True), ("other settings", False), ("stale", False), ("half", False)]),
    "azw3_headers": values_sql("name VARCHAR, error VARCHAR", [("good", None), ("short", "invalid header"), ("wrong", "invalid header")]),
}
QUERIES = {k: globals()[k] for k in SQL}
