"""Problem 3: lines repeated across the documents of one source.

Lines are compared by a key (digits, white space, case and width don't count). For every source and key the books
that have the line are counted inside and outside the source; the log-likelihood ratio of the two rates is the measure of
excess, and a false-discovery threshold over all pairs of source and key, however rare, says which are significant. The threshold is
read off a histogram of the ratios, so no global sort is needed.

Significant lines are the candidates. The stated rule decides: a line is removed if it stands in at least `MIN_BOOKS` books of the
source and in at least `MIN_SHARE` of the source's books. The rule is also a documented override: a line that it names is a
candidate even without significance, as a line that is as common in other sources has no excess here and yet counts.
`tested` marks which of the two made a line a candidate, and `verdicts` counts them.

Removal is an anti-join of the lines with the places found, and the lines that stay are put together again by their position. Only items
with such a line are cut into lines; all others pass as they are.

Counting uses 64-bit hashes of the keys in a first pass that keeps the shuffle small; lines whose hash passes are counted
again by the key itself, so a hash clash can't make a case. A running head inside a block (its first of several lines, equal to a
head of the book) is furniture and doesn't count. A null source or book has no lines to remove; null and empty
texts have no lines; a block delivered twice counts once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianth.llm.page_lines import BOTTOM, PAGE_NUMBER, TOP, line_key, text_items
from folianth.sources.tables import written

MIN_BOOKS, MIN_SHARE = 3, 0.25
FALSE_DISCOVERY = 0.01
BINS = 2000


HEAD_TYPES = ["header", "page_header"]


def head_key(line: Column) -> Column:
    """The comparison key of a running head: without its page number and the marks around it."""
    return F.regexp_replace(line_key(line), r"(?U)[^\p{L}]+", "")


def source_lines(blocks: DataFrame) -> DataFrame:
    """(block_id, book, source, line_no, line, key, h, several, head): the lines that count, with the hash of their key.

    Rows with `line_no` 0 are the running heads of the books, told by type or by their place on the page; for them and for first lines
    `head` is the hash of the head's key. Written once: cutting and folding the texts is the costly step, and the passes that follow each
    read few of these columns.
    """
    items = text_items(blocks, HEAD_TYPES).where(F.col("body").isNotNull() & F.col("source").isNotNull() & F.col("book").isNotNull())
    zone = ~F.coalesce(F.col("top").between(TOP, BOTTOM), F.lit(True)) | F.col("type").isin(HEAD_TYPES)
    pieces = F.split("body", "\n")
    lines = items.where(zone | ~F.col("titled")).select("block_id", "book", "source", zone.alias("zone"), (F.size(pieces) > 1).alias("several"), F.posexplode(F.when(zone, F.slice(pieces, 1, 1)).otherwise(pieces)).alias("at", "line"))
    lines = lines.select("block_id", "book", "source", F.when(F.col("zone"), 0).otherwise(F.col("at") + 1).alias("line_no"), "line", "several", line_key(F.col("line")).alias("key"))
    lines = lines.where(F.col("key").rlike(r"\p{L}") & ~F.col("line").rlike(PAGE_NUMBER))
    head = F.when((F.col("line_no") == 0) | (F.col("line_no") == 1) & F.col("several"), F.xxhash64(head_key(F.col("line"))))
    return written(lines.select("*", F.xxhash64("key").alias("h"), head.alias("head")), "source-lines")


def books_of(blocks: DataFrame) -> DataFrame:
    """(source, books) over all items of whatever type."""
    pairs = blocks.where(F.col("source").isNotNull() & F.col("book").isNotNull()).select("source", "book").distinct()
    return pairs.groupBy("source").agg(F.count(F.lit(1)).alias("books"))


def _term(k: Column, n: Column, p: Column) -> Column:
    q = F.lit(1.0) - p
    return F.when(k > 0, k * F.log(F.greatest(p, F.lit(1e-300)))).otherwise(0.0) + F.when(n > k, (n - k) * F.log(F.greatest(q, F.lit(1e-300)))).otherwise(0.0)


def log_likelihood_ratio(inside: Column, books: Column, outside: Column, other_books: Column) -> Column:
    """G² of the rates `inside/books` and `outside/other_books`; negative where the source has the lower rate."""
    k1, n1, k2, n2 = (x.cast("double") for x in (inside, books, outside, other_books))
    p1, p2, p = k1 / n1, F.when(n2 > 0, k2 / n2).otherwise(0.0), (k1 + k2) / (n1 + n2)
    g = 2 * (_term(k1, n1, p1) + _term(k2, n2, p2) - _term(k1, n1, p) - _term(k2, n2, p))
    return F.round(F.when(p1 >= p2, F.greatest(g, F.lit(0.0))).otherwise(-F.abs(g)), 6)


def discovery_threshold(ratios: DataFrame, rate: float = FALSE_DISCOVERY) -> float:
    """The least ratio that is significant at this false-discovery rate (Benjamini-Hochberg), to the width of a bin.

    Every row of `ratios` (llr) is a test, whatever its sign. One row for each bin reaches the driver.
    """
    bins = ratios.groupBy(F.when(F.col("llr") > 0, F.least(F.floor(F.col("llr") * 20), F.lit(BINS))).otherwise(-1).alias("bin")).count().collect()
    tests = sum(r["count"] for r in bins)
    above, best = 0, math.inf
    for bin_no, n in sorted(((r["bin"], r["count"]) for r in bins if r["bin"] >= 0), reverse=True):
        above += n
        p = 0.5 * math.erfc(math.sqrt(bin_no / 20 / 2))
        if p <= rate * above / max(tests, 1):
            best = bin_no / 20
    return best


def counted(lines: DataFrame, books: DataFrame) -> DataFrame:
    """(source, h, inside, outside, books, llr) of every pair of a source and a hashed key.

    Books are counted after the distinct rows of (source, key, book), which combine before the shuffle; a key that a third
    of all lines have is so one row for each book, and then one row for each source.
    """
    per_source = written(lines.where(F.col("line_no") > 0).select("source", "h", "book").distinct().groupBy("h", "source").agg(F.count(F.lit(1)).alias("inside")), "line-counts")
    everywhere = per_source.groupBy("h").agg(F.sum("inside").alias("everywhere"))
    total = books.agg(F.sum("books").alias("n")).collect()[0]["n"] or 0
    rows = per_source.join(everywhere, "h").join(books, "source").withColumn("outside", F.col("everywhere") - F.col("inside"))
    return rows.select("source", "h", "inside", "outside", "books", log_likelihood_ratio(F.col("inside"), F.col("books"), F.col("outside"), F.lit(total) - F.col("books")).alias("llr"))


def by_rule(min_books: int = MIN_BOOKS, min_share: float = MIN_SHARE) -> Column:
    return (F.col("inside") >= min_books) & (F.col("inside") >= min_share * F.col("books"))


class Excess:
    """The lines of a corpus with the excessive ones among them."""

    def __init__(self, blocks: DataFrame, min_books: int = MIN_BOOKS, min_share: float = MIN_SHARE):
        self.blocks, self.rule = blocks, by_rule(min_books, min_share)
        self.lines, books = source_lines(blocks), books_of(blocks)
        every = counted(self.lines, books)
        self.threshold = discovery_threshold(every)
        # the candidates, written so that their number is known when the lines meet them: while they are few no line is shuffled
        self.tested = written(every.select("*", (F.col("llr") >= self.threshold).alias("significant"), self.rule.alias("named")).where(F.col("significant") | F.col("named")), "tested-lines")

    def verdicts(self) -> DataFrame:
        """(significant, named, lines): how many candidates the ratio found, and how many the rule names."""
        return self.tested.groupBy("significant", "named").agg(F.count(F.lit(1)).alias("lines"))

    def _hits(self) -> DataFrame:
        """The places of the candidates' lines that are no running heads."""
        heads = self.lines.where(F.col("line_no") == 0).select("book", "head").distinct()
        held = self.lines.where(F.col("line_no") > 0).join(self.tested.where("named").select("source", "h", "outside", "books", "llr", "significant"), ["source", "h"])
        first = held.where(F.col("head").isNotNull()).join(heads, ["book", "head"], "left_anti")
        return written(held.where(F.col("head").isNull()).unionByName(first), "excess-lines")

    def keys(self) -> tuple[DataFrame, DataFrame]:
        """(places, keys): the exact count by key, as one hash may stand for two keys, and the keys that still meet the rule."""
        hits = self._hits()
        one = hits.groupBy("source", "key", "books", "outside", "llr", "significant", "book").agg(F.min("line").alias("line"))
        exact = one.groupBy("source", "key", "books", "outside", "llr", "significant").agg(F.count(F.lit(1)).alias("inside"), F.min("line").alias("line"))
        return hits, written(exact.where(self.rule), "excess-keys")

    def report(self) -> DataFrame:
        """(source, key, line, inside, books, outside, llr, significant): the lines to remove, by source."""
        return self.keys()[1].select("source", "key", "line", "inside", "books", "outside", "llr", "significant")

    def places(self) -> DataFrame:
        """(block_id, line_no) of every occurrence of an excessive line in a block of its source."""
        hits, keys = self.keys()
        return hits.join(keys.select("source", "key"), ["source", "key"], "left_semi").select("block_id", "line_no").distinct()

    def removed(self) -> DataFrame:
        """(book, seq, block_id, text): the text items without their excessive lines; an item of only such lines goes."""
        gone = written(self.places(), "excess-places")
        touched = gone.select("block_id").distinct()
        items = text_items(self.blocks).where(F.col("body").isNotNull()).select("book", "seq", "block_id", F.col("body").alias("text")).dropDuplicates(["block_id"])
        cut = items.join(touched, "block_id", "left_semi").select("book", "seq", "block_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("line_no", F.col("at") + 1)
        kept = cut.join(gone, ["block_id", "line_no"], "left_anti").groupBy("block_id").agg(F.first("book").alias("book"), F.first("seq").alias("seq"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("lines"))
        again = kept.select("book", "seq", "block_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))
        return items.join(touched, "block_id", "left_anti").select("book", "seq", "block_id", "text").unionByName(again)


def excess(blocks: DataFrame, min_books: int = MIN_BOOKS, min_share: float = MIN_SHARE) -> DataFrame:
    return Excess(blocks, min_books, min_share).report()


def excess_places(blocks: DataFrame) -> DataFrame:
    return Excess(blocks).places()


def without_excess(blocks: DataFrame) -> DataFrame:
    return Excess(blocks).removed()
