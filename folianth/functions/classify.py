"""Predicates that classify titles, lines and links; each as a Spark expression and as SQL.

Null texts give null. Patterns have no look-around, as in folianth.functions.rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from folianth.functions import rules as R
from folianth.functions.rules import DIGIT, NOT_WORD, NUMERAL, SHORT_NUMERAL, SP, as_sql, quoted

# Patterns and word lists of the predicates.
ENTRY_LOCATOR = R.LOCATOR + SP + "*$"
ENTRY_BARE = rf"^(?:第{NUMERAL}+[篇部卷章节讲]|{DIGIT}{{1,3}}[.、]{SP}*|{SHORT_NUMERAL}+[、.．]{SP}*).{{2,90}}{SP}+{DIGIT}{{1,4}}$"
LABEL_BARE = rf"^{R.CHAPTER_OR_NUMERAL}(?:.*?){SP}+{DIGIT}{{1,4}}$"
LEADING_PAGE = rf"(?:^|{SP}){DIGIT}{{1,4}}{SP}+[一-鿿A-Za-z]"
NAMED_FRONT = "^(?:目录|序|前言|引言|致谢|跋|后记|参考文献|附录|作者介绍|译者序|推荐序)$"
FRONT_WORDS = ["序", "序言", "前言", "引言", "导言", "绪论", "后记", "结语", "尾声", "致谢", "参考文献", "参考资料", "附录", "索引"]
AFTER = rf"(?:{NOT_WORD}|$)"
STRUCTURE = rf"(?i)(?:第{SP}*[一二三四五六七八九十百千万零〇两0-9０-９]+{SP}*[篇部卷编章节讲回]|[上中下]{SP}*[篇部卷编]|(?:chapter|part|section){SP}+[0-9ivxlcdm]+{AFTER}|^[0-9]{{1,3}}{SP}*[.、．]{SP}*[^0-9])"
TOC_WORD = rf"(?i)(?:^|{SP})(?:目录|目次|contents?)(?:{SP}|$)"
PAGE_ONLY = rf"(?i)^[\[（(]?{SP}*[ivxlcdm0-9０-９一二三四五六七八九十百]+{SP}*[\]）)]?$"
PAGE_SUFFIX = rf"(?:\.{{2,}}|…+|·{{2,}}|/{{1,2}}|{SP}){SP}*[\[（(]?{DIGIT}{{1,4}}[\]）)]?{SP}*$"
PIPE_END = r"\|" + SP + "*$"
FALLBACK = rf"^(?:第{NUMERAL}+[讲章节篇部](?:{NOT_WORD}.*)?|第{SHORT_NUMERAL}+部分(?:{NOT_WORD}.*)?)$"
CLOSING = r"[。；，！？：;,.!?]$"
PAGE_LINE = rf"(?i)^(?:{SP}*{DIGIT}+{SP}*|{SP}*page{SP}+{DIGIT}+{SP}*|{SP}*第{SP}*{DIGIT}+{SP}*页{SP}*)$"
LABEL_PREFIX = rf"(?i)^{SP}*text(?:{SP}*[-:：]|{SP}+)"
LABEL_LOCATOR = rf"(?:[/／]{{1,2}}|[.．…_]{{2,}}){SP}*[（(]?{DIGIT}{{1,4}}[）)]?{SP}*$"
LABEL_PAGE = rf"^{SP}*{DIGIT}{{2,4}}{SP}*$"
LABEL_TOC = r"(?i)^(?:目录|目次|contents?|table of contents)$"
IMAGE_ENDS = r"(?i)\.(?:apng|avif|bmp|gif|jpeg|jpg|png|svg|tif|tiff|webp)$"
RICH_SKIPPED_TYPES = ["page_header", "page_footer", "page_number", "page_aside_text"]
SKIPPED_TYPES = ["header", "footer", "page_number", "aside_text", "page_header", "page_footer", "page_aside_text"]


@dataclass(frozen=True)
class Predicate:
    """An expression in both dialects."""

    column: object
    sql: object

    def __call__(self, text: Column) -> Column:
        return self.column(text)


def _let(value: Column, body) -> Column:
    """`body` of a value that is evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(x: Column, pattern: str) -> Column:
    return F.regexp_count(x, F.lit(pattern))


def _count_sql(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {quoted(pattern)}))"


def _entry(x: Column) -> Column:
    return _let(R.apply([*R.extractor_text, R.COLLAPSE, *R.STRIP], x), lambda t: (t != "") & (F.length(t) <= 120) & (t.rlike(ENTRY_LOCATOR) | t.rlike(ENTRY_BARE)))


def _entry_sql(x: str) -> str:
    t = as_sql([*R.extractor_text, R.COLLAPSE, *R.STRIP], x)
    return f"({t} <> '' AND length({t}) <= 120 AND (regexp_matches({t}, {quoted(ENTRY_LOCATOR)}) OR regexp_matches({t}, {quoted(ENTRY_BARE)})))"


def _label(x: Column) -> Column:
    t = R.apply("tags_to_nothing", x)
    return (F.length(t) <= 140) & (t.rlike(R.LOCATOR + SP + "*$") | t.rlike(LABEL_BARE))


def _label_sql(x: str) -> str:
    t = as_sql("tags_to_nothing", x)
    return f"(length({t}) <= 140 AND (regexp_matches({t}, {quoted(R.LOCATOR + SP + '*$')}) OR regexp_matches({t}, {quoted(LABEL_BARE)})))"


def _page(slash: bool):
    def column(x: Column) -> Column:
        head = F.substring(x, 1, 700)
        places, pages, word = _count(head, R.LOCATOR_LOW), _count(head, LEADING_PAGE), head.contains("目录") | head.contains("Contents")
        out = (word & ((places >= 1) | (pages >= 3))) | (places >= 2)
        return out | (head.contains("/") & (places >= 1)) if slash else out

    def sql(x: str) -> str:
        head = f"substring({x}, 1, 700)"
        places, pages, word = _count_sql(head, R.LOCATOR_LOW), _count_sql(head, LEADING_PAGE), f"(contains({head}, '目录') OR contains({head}, 'Contents'))"
        out = f"({word} AND ({places} >= 1 OR {pages} >= 3)) OR {places} >= 2"
        return f"({out} OR (contains({head}, '/') AND {places} >= 1))" if slash else f"({out})"

    return Predicate(column, sql)


#: How a heading can begin at all, after the prefixes that cleaning drops.
BEGINS = rf"(?i)^{SP}*(?:(?:text|paragraph)[\-:：{SP[1:-1]}]*)*(?:第|{DIGIT}|{SHORT_NUMERAL}|目录|序|前言|引言|致谢|跋|后记|参考文献|附录|作者介绍|译者序|推荐序)"


def _level(x: Column) -> Column:
    # most lines can't be headings and end at one look; the chain of the others is computed once for both questions
    def told(t: Column) -> Column:
        entry = (t != "") & (F.length(t) <= 120) & (t.rlike(ENTRY_LOCATOR) | t.rlike(ENTRY_BARE))
        return F.when(entry, 0).otherwise(_let(R.apply(R.label_title[-3:], t), _title_level))

    return F.when(x.isNull(), None).when(~x.rlike(BEGINS), 0).otherwise(_let(R.apply([*R.extractor_text, R.COLLAPSE, *R.STRIP], x), told))


def _title_level(t: Column) -> Column:
    dots = F.length(t) - F.length(F.replace(t, F.lit("."), F.lit("")))
    return (
        F.when((t == "") | (F.length(t) > 80), 0).when(t.rlike(NAMED_FRONT), 1).when(t.rlike(f"^第{NUMERAL}+[篇部卷章]{AFTER}"), 1).when(t.rlike(f"^第{NUMERAL}+节{AFTER}"), 2)
        .when(t.rlike(rf"^{DIGIT}+{SP}+[^\s]"), 2).when(t.rlike(rf"^{DIGIT}+(?:\.{DIGIT}+){{1,3}}{SP}*[^\s]"), F.least(dots + 2, F.lit(4))).when(t.rlike(rf"^{SHORT_NUMERAL}+[、.．]{SP}*[^\s]"), 2).otherwise(0)
    )


def _level_sql(x: str) -> str:
    t = as_sql("label_title", x)
    m = lambda p: f"regexp_matches({t}, {quoted(p)})"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {_entry_sql(x)} OR {t} = '' OR length({t}) > 80 THEN 0 WHEN {m(NAMED_FRONT)} THEN 1 WHEN {m(f'^第{NUMERAL}+[篇部卷章]{AFTER}')} THEN 1 WHEN {m(f'^第{NUMERAL}+节{AFTER}')} THEN 2 "
        rf"WHEN {m(rf'^{DIGIT}+{SP}+[^\s]')} THEN 2 WHEN {m(rf'^{DIGIT}+(?:\.{DIGIT}+){{1,3}}{SP}*[^\s]')} THEN least(length({t}) - length(replace({t}, '.', '')) + 2, 4) WHEN {m(rf'^{SHORT_NUMERAL}+[、.．]{SP}*[^\s]')} THEN 2 ELSE 0 END"
    )


def _fallback(x: Column) -> Column:
    return _let(R.apply(R.STRIP, x), lambda t: (t != "") & (F.length(t) <= 90) & ~_entry(t) & ~t.rlike(CLOSING) & t.rlike(FALLBACK))


def _fallback_sql(x: str) -> str:
    t = as_sql(R.STRIP, x)
    return f"({t} <> '' AND length({t}) <= 90 AND NOT {_entry_sql(t)} AND NOT regexp_matches({t}, {quoted(CLOSING)}) AND regexp_matches({t}, {quoted(FALLBACK)}))"


def _body_list(x: Column) -> Column:
    t = R.apply("tags_to_nothing", x)
    return t.rlike(rf"^{DIGIT}{{1,3}}[.、]{SP}*[^\s]") & ((F.length(t) > 36) | t.rlike("[。？！；，：]"))


def _body_list_sql(x: str) -> str:
    t = as_sql("tags_to_nothing", x)
    return rf"(regexp_matches({t}, {quoted(rf'^{DIGIT}{{1,3}}[.、]{SP}*[^\s]')}) AND (length({t}) > 36 OR regexp_matches({t}, '[。？！；，：]')))"


def _hygiene(x: Column) -> Column:
    t = R.apply("clean_text", x)
    return F.when(t == "", "empty label").when(t.rlike(LABEL_PREFIX), "text prefix in label").when(t.rlike(LABEL_LOCATOR) | t.rlike(LABEL_PAGE), "page locator in label").when(t.rlike(LABEL_TOC), "printed contents page exposed as navigation")


def _hygiene_sql(x: str) -> str:
    t = as_sql("clean_text", x)
    m = lambda p: f"regexp_matches({t}, {quoted(p)})"
    return f"CASE WHEN {t} = '' THEN 'empty label' WHEN {m(LABEL_PREFIX)} THEN 'text prefix in label' WHEN {m(LABEL_LOCATOR)} OR {m(LABEL_PAGE)} THEN 'page locator in label' WHEN {m(LABEL_TOC)} THEN 'printed contents page exposed as navigation' END"


def _both(*patterns: str, longest: int | None = None) -> Predicate:
    def column(x: Column) -> Column:
        out = x.rlike(patterns[0])
        for p in patterns[1:]:
            out = out | x.rlike(p)
        return out if longest is None else (F.length(x) <= longest) & out

    def sql(x: str) -> str:
        out = " OR ".join(f"regexp_matches({x}, {quoted(p)})" for p in patterns)
        return f"({out})" if longest is None else f"(length({x}) <= {longest} AND ({out}))"

    return Predicate(column, sql)


printed_entry = Predicate(_entry, _entry_sql)
printed_label = Predicate(_label, _label_sql)
printed_target = _page(True)
printed_snippet = _page(False)
toc_line = _both(R.LEADER_PAGE, PIPE_END)
body_list_label = Predicate(_body_list, _body_list_sql)
heading_level = Predicate(_level, _level_sql)
fallback_heading = Predicate(_fallback, _fallback_sql)
probable_toc_line = _both(PAGE_SUFFIX, STRUCTURE, longest=200)
page_line = _both(PAGE_LINE)
label_hygiene = Predicate(_hygiene, _hygiene_sql)
image_path = _both(IMAGE_ENDS)

PREDICATES = {
    "printed_entry": printed_entry, "printed_label": printed_label, "printed_target": printed_target, "printed_snippet": printed_snippet, "toc_line": toc_line, "body_list_label": body_list_label,
    "heading_level": heading_level, "fallback_heading": fallback_heading, "probable_toc_line": probable_toc_line, "page_line": page_line, "label_hygiene": label_hygiene,
}
