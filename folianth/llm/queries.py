"""Queries of the llm operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folianth.llm import abuse, canonical, leakage, markup, mixing, scan_repair, site_lines
from folianth.sources.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.same_look(table(spark, sf_dir, "spec_entries"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_repair.noise(table(spark, sf_dir, "content_blocks"))


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_repair.paragraphs(table(spark, sf_dir, "content_blocks"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.excess_places(table(spark, sf_dir, "content_blocks"))


def p3_excess_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.excess(table(spark, sf_dir, "content_blocks"))


def p3_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.Excess(table(spark, sf_dir, "content_blocks")).verdicts()


def p3_without_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.without_excess(table(spark, sf_dir, "content_blocks"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup_kinds(table(spark, sf_dir, "content_blocks"))


def p5_clean_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_fields(table(spark, sf_dir, "content_blocks"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p6_without_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.without_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.checks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_exact_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest mixture that meets every share within every cap."""
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), total_blocks=mixing.EXACT)


def p7_exact_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the largest mixture that meets every share within every cap."""
    return mixing.shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), total_blocks=mixing.EXACT)


def p7_document_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_uses(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_packed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.packed(mixing.mixture(docs, table(spark, sf_dir, "mix_targets")), docs)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.flagged(table(spark, sf_dir, "documents"))


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.scores(table(spark, sf_dir, "documents"))


def p8_source_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.rates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql() -> dict[str, str]:
    """Only the lines of a source can be told in SQL; the others are tested against brute force, held-out accuracy or exact sums."""
    from folianth.llm.page_lines import BOTTOM, NARROW, PAGE_NUMBER, TOP, WIDE

    key = f"regexp_replace(lower(translate(line, {_sql_text(WIDE)}, {_sql_text(NARROW)})), '[\\p{{Nd}}\\s\\p{{Z}}\\x{{feff}}\\x{{200b}}]+', '', 'g')"
    number = _sql_text(PAGE_NUMBER.replace("(?iU)", "(?i)"))
    lines = f"""items AS (SELECT block_id, any_value(book) AS book, any_value(source) AS source, any_value(item) AS item FROM content_blocks WHERE type = 'text' AND json_valid(item) GROUP BY block_id),
    heads AS (SELECT DISTINCT book, regexp_replace(regexp_replace(lower(translate(string_split(item ->> '$.text', chr(10))[1], {_sql_text(WIDE)}, {_sql_text(NARROW)})), '[\\p{{Nd}}\\s\\p{{Z}}]+', '', 'g'), '[^\\p{{L}}]+', '', 'g') AS head FROM content_blocks WHERE json_valid(item) AND book IS NOT NULL AND source IS NOT NULL AND (type IN ('header', 'page_header') OR type = 'text' AND json_array_length(item, '$.bbox') = 4 AND CAST(item ->> '$.bbox[1]' AS DOUBLE) NOT BETWEEN {TOP} AND {BOTTOM})),
    texts AS (SELECT block_id, book, source, item ->> '$.text' AS body FROM items WHERE source IS NOT NULL AND book IS NOT NULL AND (item ->> '$.text_level') IS NULL AND (item ->> '$.text') IS NOT NULL AND coalesce(CASE WHEN json_array_length(item, '$.bbox') = 4 THEN CAST(item ->> '$.bbox[1]' AS DOUBLE) END BETWEEN {TOP} AND {BOTTOM}, true)),
    cut AS (SELECT block_id, book, source, len(s) > 1 AS several, unnest(range(1, len(s) + 1)) AS line_no, unnest(s) AS line FROM (SELECT *, string_split(body, chr(10)) AS s FROM texts)),
    lines AS (SELECT *, {key} AS key FROM cut WHERE NOT regexp_matches(line, {number}) AND regexp_matches({key}, '\\p{{L}}') AND NOT (several AND line_no = 1 AND EXISTS (SELECT 1 FROM heads WHERE heads.book = cut.book AND heads.head = regexp_replace({key}, '[^\\p{{L}}]+', '', 'g')))),
    books AS (SELECT source, count(DISTINCT book) AS books FROM content_blocks WHERE source IS NOT NULL GROUP BY source),
    excess AS (SELECT source, key FROM lines JOIN books USING (source) GROUP BY source, key, books HAVING count(DISTINCT book) >= 3 AND count(DISTINCT book) >= 0.25 * books)"""
    return {
        "p7_checks": "SELECT name, true AS holds FROM (VALUES ('caps'), ('slots'), ('blocks'), ('shares'), ('whole')) t(name)",
        "p3_found": f"WITH {lines} SELECT DISTINCT block_id, CAST(line_no AS INTEGER) AS line_no FROM lines JOIN excess USING (source, key)",
        "p3_without_excess": f"""WITH {lines}, seqs AS (SELECT block_id, any_value(book) AS book, any_value(seq) AS seq, any_value(item) AS item FROM content_blocks WHERE type = 'text' AND json_valid(item) GROUP BY block_id),
    every AS (SELECT block_id, book, seq, unnest(range(1, len(s) + 1)) AS line_no, unnest(s) AS line FROM (SELECT *, string_split(item ->> '$.text', chr(10)) AS s FROM seqs WHERE (item ->> '$.text') IS NOT NULL)),
    gone AS (SELECT DISTINCT block_id, line_no FROM lines JOIN excess USING (source, key))
    SELECT book, seq, block_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM every e WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.block_id = e.block_id AND g.line_no = e.line_no) GROUP BY book, seq, block_id""",
    }
