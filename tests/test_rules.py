import pytest
from pyspark.sql import functions as F

from folianth.functions import classify, rules
from folianth.functions.formula import inline

CASES = [
    ("key_coverage", "第二讲 潮汐", "第二讲潮汐"), ("key_coverage", "第二讲|潮汐", "第二讲潮汐"), ("key_coverage", "A B", "ab"), ("page_suffix", "潮汐……48", "潮汐"), ("page_suffix", "凡例|9|", "凡例"), ("key_resolve", "A.B…•c", "a.b…c"),
    ("tags_to_space", "a<b>b</b>&amp;lt;", "a b &lt;"), ("tags_to_nothing", "a<b>b</b>", "ab"), ("extractor_text", "text - 甲\r\nhyphen-\nated  x", "甲\nhyphenated x"), ("label_evidence", "第三章 收尾 ...... 12", "第三章 收尾"), ("label_evidence", "第三章 收尾 12", "第三章 收尾"),
    ("label_evidence", "数目 12", "数目 12"), ("label_printed", "数目 12", "数目"), ("label_fixpoint", "第一章 …… 3 (4) 5", "第一章"), ("label_title", "标题 · 12", "标题"), ("image_alt", "[]\n", "image"), ("list_item", "paragraph: x", "x"), ("html_artifacts", "<li>text - a</li>", "<li>a</li>"), ("label_fixpoint", "题 1 2 3 4 5 6 7 8 9 10", "题"), ("label_fixpoint", "甲：3（4）. 5 / 6", "甲："), ("label_fixpoint", "1999", "1999"), ("clean_text", "caf&eacute;&mdash;&#8217;&#x41; &nope; &amp;lt; &#128;", "café—’A &nope; &lt; €"), ("key_resolve", "y" * 300 + " 。z", "y" * 300 + "z"), ("clean_text", "", ""), ("clean_text", None, None),
]


def test_rules(spark):
    df = spark.createDataFrame([(i, c[1]) for i, c in enumerate(CASES)], "i int, t string")
    for rule in {c[0] for c in CASES}:
        got = {r.i: r.v for r in df.select("i", rules.apply(rule, F.col("t")).alias("v")).collect()}
        assert {i: got[i] for i, c in enumerate(CASES) if c[0] == rule} == {i: c[2] for i, c in enumerate(CASES) if c[0] == rule}, rule


PREDICATES = [
    ("heading_level", "第二章 潮水涨落 12", 0), ("heading_level", "第一章", 1), ("heading_level", "第三章涨潮", 0), ("heading_level", "1.2.3 x", 4), ("heading_level", "目录", 1), ("heading_level", "一、开始", 2), ("printed_entry", "第二章 潮水涨落 12", True), ("printed_entry", "", False),
    ("toc_line", "谢词……71", True), ("toc_line", "正文 60", False), ("fallback_heading", "第六章 平潮", True), ("fallback_heading", "第六章平潮。", False), ("body_list_label", "12. 一句话。", True), ("label_hygiene", "目录", "printed contents page exposed as navigation"), ("label_hygiene", "Intro", None),
]


def test_predicates(spark):
    df = spark.createDataFrame([(i, c[1]) for i, c in enumerate(PREDICATES)], "i int, t string")
    for name in {c[0] for c in PREDICATES}:
        got = {r.i: r.v for r in df.select("i", classify.PREDICATES[name](F.col("t")).alias("v")).collect()}
        assert {i: got[i] for i, c in enumerate(PREDICATES) if c[0] == name} == {i: c[2] for i, c in enumerate(PREDICATES) if c[0] == name}, name


def test_links(spark):
    df = spark.createDataFrame([("OEBPS/Nav/toc.ncx", "../Text/a%20b+c.xhtml#x%31")], "base string, link string")
    file, fragment = rules.split_source(F.col("link"))
    r = df.select(rules.joined_path(F.col("base"), file).alias("f"), fragment.alias("g")).collect()[0]
    assert (r.f, r.g) == ("OEBPS/Text/a b+c.xhtml", "x1")


@pytest.mark.parametrize("latex, want", [(r"\alpha_{1}^2", "α<sub>1</sub><sup>2</sup>"), (r"\frac{a}{b_{2}}", '<span class="frac"><sup>a</sup>/<sub>b<sub>2</sub></sub></span>'), (r"\mathrm{SE} < 1", "SE &lt; 1"), (r"\vartheta \dots \Leftarrow \Leftrightarrow", "ϑ … ⇐ ⇔")])
def test_formulas(latex, want):
    assert inline(latex) == f'<span class="math-inline">{want}</span>'
    assert inline(None) is None


def test_unescaping_equals_the_standard_library(spark):
    import html
    import random

    rng = random.Random(8)
    parts = ["&lt;", "&amp;", "&eacute;", "&hellip;", "&#65;", "&#x4e2d;", "&#0;", "&#55296;", "&#1114112;", "&#150;", "&bogus;", "& ", "a", "潮", "\n", ";"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(300)] + [None, "", "&", "&;", "&#;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", rules.unescaped(F.col("t")).alias("v")).collect()}
    assert [got[i] for i in range(len(texts))] == [None if t is None else html.unescape(t) for t in texts]


def test_peeling_equals_a_plain_loop(spark):
    import random
    import re

    rng = random.Random(2)
    texts = ["".join(rng.choices(["题", " ", "1", "23", "……", "（4）", "：", "/", ".", "。", "x"], k=rng.randint(0, 14))) for _ in range(400)]

    def peel(t):
        t = t.strip()
        while True:
            u = re.sub(r"(?:\s*(?:[._·•…⋯]+|[/／]{1,2})\s*|\s+)\d{1,4}\s*$", "", t)
            u = re.sub(r"(?<=[：:，,。.!！?？）》\]])\s*\d{1,4}\s*$", "", u)
            u = re.sub(r"\s*[（(]\s*\d{1,4}\s*[）)]\s*$", "", u).strip().rstrip("./／").strip()
            if u == t:
                return t
            t = u

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.v for r in df.select("i", rules.apply("label_fixpoint", F.col("t")).alias("v")).collect()}
    assert [(t, got[i]) for i, t in enumerate(texts)] == [(t, peel(t)) for t in texts]
