import hashlib
import json
import random
import re

from pyspark.sql import functions as F

from folianth.operators import layout, markdown, provenance, resolve
from folianth.streaming.incremental import convert_new


def md(spark, text):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(text.split("\n"))], "doc_id bigint, line_no bigint, line string")
    return markdown.html(markdown.blocks(lines)).collect()[0].html


def test_markdown(spark):
    assert md(spark, "**Ebb & flow < 3**") == "<p><strong>Ebb &amp; flow &lt; 3</strong></p>"
    assert md(spark, "## 目录\n### A\n#### B\ntext\nmore\n\n- x\n- y\n\n> q\n```\n- <c>\n\n```\n![a](i.png)\n![a](i.txt)") == (
        "<p><strong>目录</strong></p>\n<h1>A</h1>\n<h2>B</h2>\n<p>text more</p>\n<ul>\n<li>x</li>\n<li>y</li>\n</ul>\n<blockquote>q</blockquote>\n<pre><code>- &lt;c&gt;\n</code></pre>\n<figure><img src=\"i.png\" alt=\"a\"></figure>"
    )
    assert md(spark, "第三章 涨潮\nx") == "<h1>第三章 涨潮</h1>\n<p>x</p>"


def test_layout(spark):
    items = [
        {"type": "text", "text": "第二章 潮水涨落 12", "text_level": 1}, {"type": "title", "content": {"title_content": [{"content": "第二章 潮水涨落 12"}]}}, {"type": "title", "content": {"title_content": [{"content": "第一章 起"}]}}, {"type": "header", "text": "no"},
        {"type": "table", "content": {"table_body": "<table></table>", "table_caption": ["c"]}}, {"type": "image", "content": {"image_source": {"path": "a.png"}, "image_caption": []}}, {"type": "code", "content": {"code_content": "a\n  b", "code_language": "py"}}, {"type": "list", "content": "plain"}, {"type": "text", "text": ""},
    ]
    rows = [("b", i, i, x["type"], json.dumps(x)) for i, x in enumerate(items)] + [("b", 90, 90, "text", "{"), ("b", 91, 91, "text", None), ("b", 2, 2, "title", json.dumps(items[2]))]
    df = spark.createDataFrame(rows, "book string, seq int, block_id bigint, type string, item string")
    got = {r.seq: r.markdown for r in layout.rendered(df).collect()}
    assert got == {0: "第二章 潮水涨落", 1: "**第二章 潮水涨落**", 2: "# 第一章 起", 4: "<table></table>\n\n*c*", 5: "![image](a.png)", 6: "```py\na\n  b\n```", 7: "plain"}
    assert layout.parts(layout.rendered(df), 5).count() == 2


def test_layout_of_any_depth(spark):
    deep = "x"
    for _ in range(3000):
        deep = {"content": [deep]}
    assert layout.span_text(deep) == "x" and layout.span_text({"style": "a", "bbox": [1], "img_bbox": [2], "sub": ["b", {"type": "t", "text": "c"}]}) == "a bc"
    heads = spark.createDataFrame([("b", "Tides", "A. Keel"), ("c", "", None)], "book string, title string, author string")
    rows = spark.createDataFrame([("b", 0, 1, "one"), ("b", 7, 2, "two"), ("c", 1, 3, "three")], "book string, seq int, block_id bigint, markdown string")
    assert {(r.book, r.part): r.markdown for r in layout.parts(rows, 5, heads).collect()} == {("b", 0): "% Tides\n\n% A. Keel\n\none\n", ("b", 1): "two\n", ("c", 0): "three\n"}


def test_resolve_against_a_plain_fold(spark):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    blocks = [("b", f, k, " ".join(rng.choices(words, k=2))) for f in range(3) for k in range(12)]
    entries = [("b", i, i, " ".join(rng.choices(words, k=1)), None, rng.random() < 0.2, rng.choice([None, None, 2]), None, rng.choice([None, None, 1]), rng.choice([None, 2]), None, None) for i in range(1, 15)]
    schema = "book string, entry_id bigint, seq int, label string, search array<string>, exact boolean, occurrence int, start_file int, max_file int, window int, file_index int, block int"
    got = {r.entry_id: (r.file_index, r.block) for r in resolve.resolve(spark.createDataFrame(entries, schema), spark.createDataFrame(blocks, "book string, file_index int, block int, text string")).collect()}
    key = lambda t: re.sub(r"\s", "", t)
    by = {f: [b[3] for b in blocks if b[1] == f] for f in range(3)}
    cursor, want = (0, 0), {}
    for _, i, _, label, _, exact, occ, _, last, size, _, _ in entries:
        hits = 0
        want[i] = (None, None)
        for f in range(cursor[0], (2 if last is None else last) + 1):
            for k in range(cursor[1] if f == cursor[0] else 0, 12):
                w = key(" ".join(by[f][k : k + (size or 1)]))
                if w == label if exact else label in w:
                    hits += 1
                    if hits == (occ or 1):
                        want[i] = (f, k)
                        break
            if want[i][0] is not None:
                cursor = (want[i][0], want[i][1] + 1)
                break
    assert got == want


def test_provenance(spark):
    conf = ("vlm-engine", "auto", "ch", "m", "1")
    lit = provenance.config(*(F.lit(x) for x in conf))
    digest = hashlib.sha256(b"src").hexdigest()
    record = {"version": 1, "source_sha256": digest, "extraction_config": {"backend": "vlm-engine", "model_source": "m", "version": "1"}, "files": {"a": "1", "b": "2"}}
    base = (json.dumps(record), digest, digest, {"b": "2", "a": "1"})
    cases = [("ok", *base), ("none", None, *base[1:]), ("bytes", base[0], "x", *base[2:]), ("kept", *base[:2], "x", base[3]), ("files", *base[:3], {"a": "1"}), ("gone", *base[:3], None), ("damaged", "{", *base[1:])]
    work = spark.createDataFrame(cases, "book string, record string, source_sha256 string, kept_sha256 string, files map<string,string>").withColumn("config", lit)
    got = {r.book: r.verdict for r in provenance.verify_extractions(work).collect()}
    assert got == {"ok": None, "none": "no provenance", "bytes": "different source bytes", "kept": "kept source was modified", "files": "files changed or incomplete", "gone": "files changed or incomplete", "damaged": "no provenance"}
    changed = work.withColumn("config", provenance.config(F.lit("pipeline"), *(F.lit(x) for x in conf[1:])))
    assert {r.verdict for r in provenance.verify_extractions(changed.where("book = 'ok'")).collect()} == {"configuration changed"}
    receipt = json.dumps({"conversion_provenance": {"version": 1, "source_sha256": "s", "build_config": "c"}, "artifacts": [{"canonical": "/X/A.epub", "sha256": "h"}]})
    outs = spark.createDataFrame([("ok", "/x/a.epub", "h", "s", "c"), ("cfg", "/x/a.epub", "h", "s", "d"), ("half", "/x/a.epub", "h", "s", "c"), ("half", "/x/b.epub", "h", "s", "c")], "book string, path string, sha256 string, source_sha256 string, build_config string")
    assert {r.book: r.attested for r in provenance.attested(outs, spark.createDataFrame([(receipt,), ("{broken",), (None,)], "body string")).collect()} == {"ok": True, "cfg": False, "half": False}
    files = spark.createDataFrame([("b", "x", bytearray(b"1")), ("b", "a", bytearray(b"2"))], "book string, relpath string, content binary")
    assert provenance.inventory(files).collect()[0].files == {"a": hashlib.sha256(b"2").hexdigest(), "x": hashlib.sha256(b"1").hexdigest()}


def test_incremental(spark, tmp_path):
    src, out, seen, mark = (str(tmp_path / x) for x in ("src", "out", "seen", "mark"))
    schema = "book string, sha256 string"
    for rows in ([("a", "1"), ("a", "1"), ("b", "2")], [("b", "2"), ("c", "3")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        convert_new(spark, src, schema, lambda df: df, ["book", "sha256"], out, seen, mark).awaitTermination()
    assert sorted(r.book for r in spark.read.parquet(f"{out}/batch=*").collect()) == ["a", "b", "c"]
