"""Text normalisers, comparison keys and label cleaners as chains of patterns.

A rule is a list of (pattern, replacement) steps. `apply` turns it into a Spark expression (JVM only, inside whole-stage
codegen), `as_sql` into the same chain for an SQL engine with linear-time regular expressions, so patterns have neither
look-around nor back-references. White space, digits and word characters are spelled out, as engines differ on their classes.

Null gives null; the empty text gives the empty text (or the stated default). The near-duplicates differ on purpose.
"""

from __future__ import annotations

from functools import lru_cache
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = tuple[str, str]

# The character classes and word lists of the rules.
SP = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIGIT = r"[0-9０-９]"
WORD = r"[0-9A-Za-z_０-９À-ÖØ-öø-ɏͰ-ϿЀ-ӿ一-鿿぀-ヿ]"
NOT_WORD = r"[^0-9A-Za-z_０-９À-ÖØ-öø-ɏͰ-ϿЀ-ӿ一-鿿぀-ヿ]"
NUMERAL = r"[一二三四五六七八九十百零〇0-9０-９]"
SHORT_NUMERAL = r"[一二三四五六七八九十]"
LOCATOR = rf"(?:[.·．。…]{{2,}}|/{{1,2}}){SP}*{DIGIT}{{1,4}}"
LOCATOR_LOW = rf"(?:[.·．。…_]{{2,}}|/{{1,2}}){SP}*{DIGIT}{{1,4}}"
LEADER_PAGE = rf"(?:\.{{2,}}|…+|·{{2,}}|\|{{1,2}}|/{{1,2}}){SP}*[\[（(]?{DIGIT}{{1,4}}[\]）)]?{SP}*$"
CHAPTER = rf"(?:第{NUMERAL}+[篇部卷章节讲]|{DIGIT}{{1,3}}[.、]{SP}*)"
CHAPTER_OR_NUMERAL = rf"(?:第{NUMERAL}+[篇部卷章节讲]|{DIGIT}{{1,3}}[.、]{SP}*|{SHORT_NUMERAL}+[、.．]{SP}*)"
EDGE = r"[ .．。·…/]"
EDGE_LOW = r"[ .．。·…_]"
LIST_ARTIFACT = rf"(?mi)^({SP}*[-*+]{SP}+)(?:text|paragraph)(?:{SP}*[-:：·●◎◆■]{SP}*|{SP}+)"
ARTIFACT_MARK = rf"(?mi)^{SP}*(?:text|paragraph){SP}*[-:：]{SP}*"
ARTIFACT_SPACE = rf"(?mi)^{SP}*(?:text|paragraph){SP}+({DIGIT}{{1,4}}(?:{NOT_WORD}|$)|[一-鿿])"
ITEM_ARTIFACT = rf"(?i)^(?:text|paragraph)(?:{SP}*[-:：·●◎◆■]{SP}*|{SP}+)"
HTML_ARTIFACT = rf"(?i)(<(?:li|p|h[1-6])(?:{SP}[^>]*)?>){SP}*(?:text|paragraph)(?:{SP}*[-:：]{SP}*|{SP}+)"

COLLAPSE: Step = (SP + "+", " ")
STRIP: list[Step] = [(rf"^{SP}+", ""), (rf"{SP}+$", "")]
#: Character entities become characters, each once: a marker, not a pattern (see `unescaped`).
UNESCAPE: Step = ("&;", "&")
ENTITIES: list[Step] = [UNESCAPE]
ARTIFACTS: list[Step] = [(LIST_ARTIFACT, r"\1"), (ARTIFACT_MARK, ""), (ARTIFACT_SPACE, r"\1")]
LINE_ENDS: list[Step] = [(r"\r\n", "\n"), (r"\r", "\n")]
AROUND_LINES: list[Step] = [(r"[ \t]*\n[ \t]*", "\n"), (r"[ \t]{2,}", " ")]
CUT_WORD: list[Step] = [(rf"({WORD})-\n({WORD})", r"\1\2")] * 2


def edges(chars: str) -> list[Step]:
    return [(rf"^{chars}+", ""), (rf"{chars}+$", "")]


def bare_page_after(prefix: str) -> Step:
    """A page number at the end goes only from a text that begins with the prefix."""
    return (rf"^({prefix}.*?){SP}+{DIGIT}{{1,4}}$", r"\1")


clean_text = [*ENTITIES, COLLAPSE, *STRIP]
tags_to_space = [("<[^>]+>", " "), *clean_text]
tags_to_nothing = [("<[^>]+>", ""), *clean_text]
white_space = [COLLAPSE, *STRIP]
extractor_text = [*LINE_ENDS, *ARTIFACTS, *CUT_WORD, *AROUND_LINES, *STRIP]
rich_text = [*LINE_ENDS, *AROUND_LINES, *STRIP]
fingerprint = [*clean_text, (SP + "+", "")]
artifact_prefix = [*ARTIFACTS, *STRIP]
list_item = [*extractor_text, (ITEM_ARTIFACT, ""), *STRIP]
html_artifacts = [(HTML_ARTIFACT, r"\1")]

label_evidence = [*tags_to_space, (LOCATOR + SP + "*$", ""), bare_page_after(CHAPTER), *edges(EDGE)]
label_printed = [*tags_to_space, (LOCATOR_LOW, ""), (rf"{SP}+{DIGIT}{{1,4}}$", ""), *edges(EDGE_LOW), COLLAPSE]
label_repair = [*tags_to_nothing, (SP + "*" + LOCATOR + SP + "*$", ""), bare_page_after(CHAPTER_OR_NUMERAL), COLLAPSE, *edges(EDGE)]
_ROUND = [
    (rf"(?:{SP}*(?:[._·•…⋯]+|[/／]{{1,2}}){SP}*|{SP}+){DIGIT}{{1,4}}{SP}*$", ""), (rf"([：:，,。.!！?？）》\]]){SP}*{DIGIT}{{1,4}}{SP}*$", r"\1"), (rf"{SP}*[（(]{SP}*{DIGIT}{{1,4}}{SP}*[）)]{SP}*$", ""), *STRIP, (r"[./／]+$", ""), *STRIP,
]
#: A round for each number of the text and as many again for leaders between them: then nothing is left to peel.
FIXPOINT = _ROUND
label_fixpoint = [*STRIP, ("&*", "")]
label_title = [*extractor_text, COLLAPSE, (rf"{SP}+[·.。．]?{SP}*{DIGIT}{{1,4}}{SP}*$", ""), *STRIP]
page_suffix = [(r"\|" + SP + "*$", ""), (LEADER_PAGE, ""), *edges(EDGE)]
image_alt = [(r"[\[\]\(\)\n\r]+", " "), COLLAPSE, *STRIP, (r"^$", "image")]

key_evidence = [*label_evidence, (r"[\s\x{3000},，.。:：;；/、·．…!！?？]+", "")]
key_coverage = [(r"[\s\x{0b}\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000},，.。:：;；/、·．…!！?？\-—–_()（）\[\]【】{}《》<>\"'“”‘’|｜/\\]+", "")]
key_resolve = [(r"[\s\x{0b}\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000},，。．、；：:！？?!·•●◆◇■□▪▫\-—–_()（）\[\]【】{}《》<>\"'“”‘’/\\]+", "")]
key_printed = [*label_printed, (r"[\s\x{3000},，.．。:：;；/／_—\-]+", "")]
key_manual = [*tags_to_space, (SP + "*" + LOCATOR + SP + "*$", ""), (r"[_\s\x{3000},，.。:：;；/、·．…!！?？-]+", "")]
key_anchor = [*tags_to_nothing, (SP + "*" + LOCATOR + SP + "*$", ""), bare_page_after(CHAPTER_OR_NUMERAL), (SP + "+", ""), (r"[.．。·…/]+$", "")]
#: Keys that are compared in lower case.
LOWERED = {"key_coverage", "key_resolve"}

RULES: dict[str, list[Step]] = {
    k: v for k, v in dict(
        clean_text=clean_text, tags_to_space=tags_to_space, tags_to_nothing=tags_to_nothing, white_space=white_space, extractor_text=extractor_text, rich_text=rich_text, fingerprint=fingerprint,
        artifact_prefix=artifact_prefix, list_item=list_item, html_artifacts=html_artifacts, label_evidence=label_evidence, label_printed=label_printed, label_repair=label_repair, label_fixpoint=label_fixpoint,
        label_title=label_title, page_suffix=page_suffix, image_alt=image_alt, key_evidence=key_evidence, key_coverage=key_coverage, key_resolve=key_resolve, key_printed=key_printed, key_manual=key_manual, key_anchor=key_anchor,
    ).items()
}


NUMBERS = DIGIT + "+"
#: An entity: decimal, hexadecimal or by a name of HTML 4.
ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,8});"


@lru_cache(maxsize=1)
def entity_names() -> dict[str, str]:
    """Characters by entity name; numbers that mean a sign of the Windows character set come under their decimal name."""
    out = {k: chr(v) for k, v in name2codepoint.items()} | {"apos": "'"}
    for n in range(0x80, 0xA0):
        try:
            out[f"#{n}"] = out[f"#x{n:x}"] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            continue
    return out


def unescaped(text: Column) -> Column:
    """The text with its character entities as characters, in one pass; unknown names stay. Texts without `&` are passed by."""
    names = F.create_map(*(F.lit(x) for pair in entity_names().items() for x in pair))

    def sign(e: Column) -> Column:
        name = F.substring(e, 2, 1_000_000)
        name = F.substring(name, F.lit(1), F.length(name) - 1)
        code = F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, 3, 9), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 9)).try_cast("bigint")
        known = F.try_element_at(names, name)
        made = F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd")).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(known, F.when(code.isNotNull(), made), e)

    def whole(t: Column) -> Column:
        between, found = F.split(t, ENTITY, -1), F.regexp_extract_all(t, F.lit(ENTITY), 0)
        return F.array_join(F.transform(between, lambda x, i: F.concat(x, F.coalesce(F.get(F.transform(found, sign), i), F.lit("")))), "")

    return F.when(F.contains(text, F.lit("&")), F.element_at(F.transform(F.array(text), whole), 1)).otherwise(text)


def unescaped_sql(text: str) -> str:
    """`unescaped` as an SQL expression."""
    names = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in entity_names().items()) + "}"
    name = "e[2:-2]"
    code = f"TRY_CAST(CASE WHEN {name}[1:2] IN ('#x', '#X') THEN CAST(TRY_CAST(('0x' || {name}[3:]) AS BIGINT) AS VARCHAR) WHEN {name}[1:1] = '#' THEN {name}[2:] END AS BIGINT)"
    sign = f"coalesce({names}[{name}], CASE WHEN {code} IS NOT NULL THEN CASE WHEN {code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr(CAST({code} AS INTEGER)) END END, e)"
    split = f"string_split_regex({text}, {quoted(ENTITY)})"
    found = f"list_append(list_transform(regexp_extract_all({text}, {quoted(ENTITY)}), lambda e: {sign}), '')"
    return f"CASE WHEN contains({text}, '&') THEN array_to_string(list_transform(list_zip({split}, {found}), lambda z: z[1] || z[2]), '') ELSE {text} END"


def peeled(text: Column) -> Column:
    """Suffixes of a label peeled until nothing changes; a text that ends in no suffix, as most do, skips the rounds."""
    rounds = F.sequence(F.lit(0), 2 * F.regexp_count(text, F.lit(NUMBERS)) + 1)
    return F.when(text.rlike(rf"(?:{DIGIT}|[)）./／])$"), F.aggregate(rounds, text, lambda acc, _: apply(FIXPOINT, acc))).otherwise(text)


def peeled_sql(text: str) -> str:
    """`peeled` as an SQL expression."""
    rounds = f"list_transform(range(2 * len(regexp_extract_all({text}, {quoted(NUMBERS)})) + 2), lambda n: '')"
    return f"list_reduce(list_prepend({text}, {rounds}), lambda acc, n: {as_sql(FIXPOINT, 'acc')})"


def apply(rule: str | list[Step], text: Column) -> Column:
    """The rule as a Spark expression."""
    for pattern, repl in RULES[rule] if isinstance(rule, str) else rule:
        if pattern == "&;":
            text = unescaped(text)
        elif pattern == "&*":
            text = peeled(text)
        else:
            text = F.regexp_replace(text, pattern, repl.replace(r"\1", "$1").replace(r"\2", "$2"))
    return F.lower(text) if isinstance(rule, str) and rule in LOWERED else text


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def as_sql(rule: str | list[Step], text: str) -> str:
    """The rule as an SQL expression."""
    for pattern, repl in RULES[rule] if isinstance(rule, str) else rule:
        if pattern == "&;":
            text = unescaped_sql(text)
        elif pattern == "&*":
            text = peeled_sql(text)
        else:
            text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(repl)}, 'g')"
    return f"lower({text})" if isinstance(rule, str) and rule in LOWERED else text


ORDINAL = rf"^{SP}*(第{SP}*{NUMERAL}+{SP}*[章节讲篇部卷]|[一二三四五六七八九十百零〇]+[、.．]|{DIGIT}{{1,3}}[、.．])"


def ordinal_prefix(text: Column) -> Column:
    """The leading ordinal of a label, without white space; the empty text where there is none."""
    return F.regexp_replace(F.regexp_extract(apply("label_printed", text), ORDINAL, 1), SP + "+", "")


def ordinal_prefix_sql(text: str) -> str:
    return f"regexp_replace(regexp_extract({as_sql('label_printed', text)}, {quoted(ORDINAL)}, 1), {quoted(SP + '+')}, '', 'g')"


def split_source(src: Column) -> tuple[Column, Column]:
    """(file, fragment) of a link, percent signs decoded, not joined to any folder."""
    plain = F.replace(src, F.lit("+"), F.lit("%2B"))
    return F.try_url_decode(F.split_part(plain, F.lit("#"), F.lit(1))), F.try_url_decode(F.regexp_extract(plain, "#(.*)$", 1))


def joined_path(base: Column, link: Column) -> Column:
    """A link joined to the folder of `base`, with `.` and `..` resolved; `..` above the top stays."""
    folder = F.regexp_replace(base, r"[^/]*$", "")
    parts = F.filter(F.split(F.concat(F.when(link.startswith("/"), F.lit("")).otherwise(folder), link), "/"), lambda x: (x != "") & (x != "."))
    return F.array_join(
        F.aggregate(
            parts, F.array().cast("array<string>"),
            lambda acc, x: F.when((x == "..") & (F.size(acc) > 0) & (F.element_at(acc, -1) != ".."), F.slice(acc, 1, F.size(acc) - 1)).otherwise(F.concat(acc, F.array(x))),
        ), "/",
    )
