"""How faithfully the reviewed navigation restores a printed table of contents.

The accounting is greedy: at a line, the line itself or the line joined with the next must be a known key; a pair takes
two lines. The fold has one bit of state (the line was taken by the pair before it), and in a run of lines that would each
take their successor the bit alternates, so it is the parity of the place in the run: windows in place of a fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folianth.functions import classify, rules
from folianth.operators.ordered import BUCKET, scan
from folianth.sources.tables import written

MIN_HITS, MIN_SHARE = 5, 0.4


def printed_titles(printed: DataFrame) -> DataFrame:
    """(book, line_no, line): printed contents lines of the books whose lines are mostly such, page suffix dropped.

    Books with fewer than MIN_HITS such lines, or a smaller share than MIN_SHARE, have no printed contents. A line that comes
    twice under one number counts once. Null books and lines are left out.
    """
    rows = printed.where(F.col("book").isNotNull() & F.col("line").isNotNull()).dropDuplicates(["book", "line_no"]).withColumn("hit", classify.toc_line(F.col("line")))
    gate = rows.groupBy("book").agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("n")).where((F.col("hits") >= MIN_HITS) & (F.col("hits") >= MIN_SHARE * F.col("n"))).select("book")
    out = rows.where("hit").join(gate, "book", "left_semi").select("book", F.col("line_no").cast("bigint").alias("line_no"), rules.apply("page_suffix", F.col("line")).alias("line"))
    return out.where((F.length("line") >= 2) & ~F.col("line").rlike(classify.PAGE_ONLY) & ~F.col("line").rlike(classify.TOC_WORD))


def label_keys(entries: DataFrame) -> DataFrame:
    """(book, key, is_label, deviates, is_renamed) of every key of a book's entries."""
    label = entries.select("book", rules.apply("key_coverage", F.col("label")).alias("key"), F.lit(True).alias("is_label"), (F.col("deviation") != "").alias("deviates"), F.lit(False).alias("is_renamed"))
    renamed = entries.where(F.col("printed") != "").select("book", rules.apply("key_coverage", F.col("printed")).alias("key"), F.lit(False).alias("is_label"), F.lit(False).alias("deviates"), F.lit(True).alias("is_renamed"))
    keys = label.unionByName(renamed).where(F.length("key") > 0)
    return keys.groupBy("book", "key").agg(*(F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("is_label", "deviates", "is_renamed")))


def accounted(lines: DataFrame, keys: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """(book, line_no, line, taken, verdict): each printed line as `restored`, `explained` or `silent`.

    `lines`: printed_titles; `keys`: label_keys; `dropped`: (book, line) that the review declares as left out.
    """
    order, bucket = ["line_no"], F.floor(F.col("line_no") / BUCKET)
    rows = scan(lines, ["book"], order, bucket, following={"next_line": F.col("line")}, sum_before={"at": F.lit(1).cast("bigint")})
    rows = rows.withColumns({"k1": rules.apply("key_coverage", F.col("line")), "k2": rules.apply("key_coverage", F.concat("line", "next_line"))})
    known = keys.select("book", "key", F.when(F.col("is_label"), 1).when(F.col("is_renamed"), 2).alias("rank")).where(F.col("rank").isNotNull())
    if dropped is not None:
        known = known.unionByName(dropped.select("book", rules.apply("key_coverage", F.col("line")).alias("key"), F.lit(3).alias("rank")))
    known = known.groupBy("book", "key").agg(F.min("rank").alias("rank"))
    for k, r in (("k1", "r1"), ("k2", "r2")):
        rows = rows.join(known.select("book", F.col("key").alias(k), F.col("rank").alias(r)), ["book", k], "left")
    single = F.col("r1").isNotNull() & (F.col("r2").isNull() | (F.col("r1") <= F.col("r2")))
    # written once: a scan reads its rows twice, and all before this would be done again
    rows = written(rows.select("book", "line_no", "line", "at", (~single & F.col("r2").isNotNull()).alias("pair"), F.least("r1", "r2").alias("own")), "printed-keys")
    # the place in a run of pair lines: how many rows back the last row stands that takes no successor
    rows = scan(rows, ["book"], order, bucket, previous={"pair_before": F.col("pair"), "own_before": F.col("own")}, max_before={"run_start": F.when(~F.col("pair"), F.col("at"))})
    taken = F.coalesce(F.col("pair_before"), F.lit(False)) & ((F.col("at") - F.coalesce(F.col("run_start"), F.lit(-1))) % 2 == 0)
    rows = rows.withColumn("taken", taken)
    rank = F.when(F.col("taken"), F.col("own_before")).otherwise(F.col("own"))
    return rows.select("book", "line_no", "line", "taken", F.when(rank <= 2, "restored").when(rank == 3, "explained").otherwise("silent").alias("verdict"))


def additions(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(book, key): labels of books with printed contents that no printed line or pair shows and no deviation explains."""
    rows = scan(lines, ["book"], ["line_no"], F.floor(F.col("line_no") / BUCKET), following={"next_line": F.col("line")})
    shown = rows.select("book", rules.apply("key_coverage", F.col("line")).alias("key")).unionByName(rows.where(F.col("next_line").isNotNull()).select("book", rules.apply("key_coverage", F.concat("line", "next_line")).alias("key"))).distinct()
    return keys.where(F.col("is_label") & ~F.col("deviates")).join(lines.select("book").distinct(), "book", "left_semi").join(shown, ["book", "key"], "left_anti").select("book", "key")


def by_book(verdicts: DataFrame) -> DataFrame:
    """(book, printed_lines, restored, explained, silent, coverage)."""
    n = F.count(F.lit(1))
    restored = F.count_if(F.col("verdict") == "restored")
    return verdicts.groupBy("book").agg(n.alias("printed_lines"), restored.alias("restored"), F.count_if(F.col("verdict") == "explained").alias("explained"), F.count_if(F.col("verdict") == "silent").alias("silent"), F.round(restored / n, 4).alias("coverage"))


def gate(books: DataFrame, added: DataFrame, strict: bool = False) -> int:
    """Exit code of the coverage gate: 2 no books, 4 unexplained additions when strict, 3 silent lines, else 0."""
    row = books.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("silent"), F.lit(0)).alias("silent")).collect()[0]
    if not row["n"]:
        return 2
    if strict and added.limit(1).count():
        return 4
    return 3 if row["silent"] else 0
