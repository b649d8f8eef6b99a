"""Queries on titles: one for each normaliser, key, label cleaner and predicate."""

from __future__ import annotations

from pyspark.sql import functions as F

from folianth.functions import classify, rules
from folianth.plans.relations import LINES_SQL, TITLES_SQL, lines, titles
from folianth.sources.tables import table


def _rule(name: str):
    return lambda spark, d: titles(spark, d).select("src", "owner", "n", rules.apply(name, F.col("title")).alias("value"))


def _predicate(name: str):
    return lambda spark, d: titles(spark, d).select("src", "owner", "n", classify.PREDICATES[name](F.col("title")).alias("value"))


QUERIES = {f"text_{n}": _rule(n) for n in rules.RULES} | {f"is_{n}": _predicate(n) for n in classify.PREDICATES}
SQL = {f"text_{n}": f"WITH {TITLES_SQL} SELECT src, owner, n, {rules.as_sql(n, 'title')} AS value FROM titles" for n in rules.RULES}
SQL |= {f"is_{n}": f"WITH {TITLES_SQL} SELECT src, owner, n, {p.sql('title')} AS value FROM titles" for n, p in classify.PREDICATES.items()}


def ordinal_prefixes(spark, d):
    return titles(spark, d).select("src", "owner", "n", rules.ordinal_prefix(F.col("title")).alias("ordinal"))


def artifact_counts(spark, d):
    """Leaked prefixes in list items and headings, counted by document."""
    found = lines(spark, d).groupBy("doc_id").agg(F.sum(F.regexp_count("line", F.lit(rules.HTML_ARTIFACT))).alias("html_artifacts"), F.sum(F.regexp_count("line", F.lit(rules.LIST_ARTIFACT))).alias("list_artifacts"))
    return found.select("doc_id", F.col("html_artifacts").cast("bigint"), F.col("list_artifacts").cast("bigint"))


def image_refs(spark, d):
    """Images of documents: path, whether it names an image file, and its alternative text."""
    pattern = r"^!\[([^\]]*)\]\(([^)]*)\)"
    held = lines(spark, d).where(F.col("line").rlike(pattern))
    path = F.regexp_extract("line", pattern, 2)
    return held.select("doc_id", "line_no", path.alias("path"), classify.image_path(path).alias("is_image"), rules.apply("image_alt", F.regexp_extract("line", pattern, 1)).alias("alt"))


def type_filter(spark, d):
    """Layout items that are part of the text, by type."""
    items = table(spark, d, "content_blocks").select("block_id", "type").distinct()
    return items.where(~F.col("type").isin(classify.SKIPPED_TYPES)).groupBy("type").agg(F.count(F.lit(1)).alias("items"))


QUERIES |= {"ordinal_prefixes": ordinal_prefixes, "artifact_prefix_count": artifact_counts, "image_refs": image_refs, "layout_block_filter": type_filter}
_IMAGE = rules.quoted(r"^!\[([^\]]*)\]\(([^)]*)\)")
SQL |= {
    "ordinal_prefixes": f"WITH {TITLES_SQL} SELECT src, owner, n, {rules.ordinal_prefix_sql('title')} AS ordinal FROM titles",
    "artifact_prefix_count": f"WITH {LINES_SQL} SELECT doc_id, CAST(sum(len(regexp_extract_all(line, {rules.quoted(rules.HTML_ARTIFACT)}))) AS BIGINT) AS html_artifacts, CAST(sum(len(regexp_extract_all(line, {rules.quoted(rules.LIST_ARTIFACT)}))) AS BIGINT) AS list_artifacts FROM lines GROUP BY doc_id",
    "image_refs": f"WITH {LINES_SQL} SELECT doc_id, line_no, regexp_extract(line, {_IMAGE}, 2) AS path, {classify.image_path.sql(f'regexp_extract(line, {_IMAGE}, 2)')} AS is_image, {rules.as_sql('image_alt', f'regexp_extract(line, {_IMAGE}, 1)')} AS alt FROM lines WHERE regexp_matches(line, {_IMAGE})",
    "layout_block_filter": "SELECT type, count(*) AS items FROM (SELECT DISTINCT block_id, type FROM content_blocks) WHERE type NOT IN (" + ", ".join(rules.quoted(t) for t in classify.SKIPPED_TYPES) + ") GROUP BY type",
}
