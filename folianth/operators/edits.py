"""Edits of a navigation tree as relations: moving, renaming, deleting, pruning, adding at the edges; and the preflight of a review.

A tree is rows (book, entry_id, path, label, src); `path` holds the places from the top, so pre-order is the order of paths and an entry
lies below every entry whose path begins its own. An edit that a book doesn't allow leaves the book as it is and says why.

Null books take no part; a null label equals no other; entries without a path stay where they are and lie below nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianth.functions import rules
from folianth.operators.ordered import BUCKET, numbered, scan


def _top(path: str = "path") -> Column:
    return F.try_element_at(path, F.lit(1))


def moved(nav: DataFrame, moves: DataFrame) -> DataFrame:
    """(book, entry_id, label, play_order, error): entries numbered anew after top-level entries went before another one, with all below them.

    `moves`: book, ord, label, before. Both labels must stand exactly once at the top of the book, else nothing of the book moves.
    """
    tops = nav.where(F.size("path") == 1).groupBy("book", "label").agg(F.count(F.lit(1)).alias("n"), F.min(_top()).alias("top"))
    ask = moves.join(tops.select("book", "label", F.col("n").alias("n1"), "top"), ["book", "label"], "left").join(tops.select("book", F.col("label").alias("before"), F.col("n").alias("n2"), F.col("top").alias("goal")), ["book", "before"], "left")
    ask = ask.withColumn("error", F.when(F.col("n1").isNull() | F.col("n2").isNull(), "missing label").when((F.col("n1") > 1) | (F.col("n2") > 1), "label not unique"))
    errors = ask.groupBy("book").agg(F.max("error").alias("error"))
    good = ask.join(errors.where(F.col("error").isNull()).select("book"), "book", "left_semi").select("book", "top", "goal", "ord")
    rows = nav.withColumn("top", _top()).join(good, ["book", "top"], "left").join(errors, "book", "left")
    rows = rows.withColumns({"k1": F.coalesce("goal", "top", F.lit(0)), "k2": F.when(F.col("goal").isNull(), 1).otherwise(0), "k3": F.coalesce("ord", F.lit(0))})
    return numbered(rows, ["book"], ["k1", "k2", "k3", "path", "entry_id"], F.floor(F.col("k1") / 64), "play_order").select("book", "entry_id", "label", "play_order", "error")


def relabelled(nav: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, report): labels replaced where a change (book, src, old, new) meets exactly one entry; the report counts what each met."""
    met = changes.join(nav.select("book", "src", F.col("label").alias("old"), "entry_id"), ["book", "src", "old"], "left")
    report = met.groupBy("book", "src", "old", "new").agg(F.count("entry_id").alias("matches"), F.max("entry_id").alias("entry_id"))
    one = report.where(F.col("matches") == 1).select("entry_id", "new")
    out = nav.join(one, "entry_id", "left").withColumn("label", F.coalesce("new", "label")).drop("new")
    return out, report.select("book", "src", "old", "new", "matches")


def _below(nav: DataFrame, gone: DataFrame) -> DataFrame:
    """The ids of the entries of `gone` (book, path) and of all below them."""
    stems = nav.where(F.col("path").isNotNull()).select("book", "entry_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", F.lit(1), n))).alias("stem"))
    return stems.join(gone.select("book", F.col("path").alias("stem")).distinct(), ["book", "stem"], "left_semi").select("entry_id").distinct()


def deleted(nav: DataFrame, named: DataFrame) -> DataFrame:
    """The entries that stay when those with a label or a target of `named` (book, label, src; nulls name nothing) go with all below them."""
    by_label = nav.join(named.where(F.col("label").isNotNull()).select("book", "label").distinct(), ["book", "label"], "left_semi").select("book", "path")
    by_src = nav.join(named.where(F.col("src").isNotNull()).select("book", "src").distinct(), ["book", "src"], "left_semi").select("book", "path")
    return nav.join(_below(nav, by_label.unionByName(by_src)), "entry_id", "left_anti")


def pruned(nav: DataFrame, candidates: DataFrame, least: int) -> DataFrame:
    """(book, entry_id, label, play_order, removed): candidates (entry_id) gone with all below them, where at least `least` entries remain.

    The guard counts the candidates alone: a book that would keep fewer others stays whole.
    """
    marked = nav.join(candidates.select("entry_id").distinct().withColumn("out", F.lit(1)), "entry_id", "left")
    guard = marked.groupBy("book").agg((F.count(F.lit(1)) - F.count("out") >= least).alias("allowed"), F.count(F.lit(1)).alias("before"))
    allowed = marked.where(F.col("out") == 1).join(guard.where("allowed").select("book"), "book", "left_semi").select("book", "path")
    left = nav.join(_below(nav, allowed), "entry_id", "left_anti")
    kept = left.groupBy("book").agg(F.count(F.lit(1)).alias("after"))
    rows = numbered(left, ["book"], ["path", "entry_id"], F.floor(F.coalesce(_top(), F.lit(0)) / 64), "play_order")
    return rows.join(guard.join(kept, "book").select("book", (F.col("before") - F.col("after")).alias("removed")), "book").select("book", "entry_id", "label", "play_order", "removed")


def edged(nav: DataFrame, additions: DataFrame) -> DataFrame:
    """(book, label, play_order, error): entries with additions (book, ord, position, label) before the first or after the last.

    A label that the book already has, or a position that is neither `start` nor `end`, makes an error row without a number.
    """
    clean = rules.apply("clean_text", F.col("label"))
    known = nav.select("book", clean.alias("key")).distinct().withColumn("held", F.lit(True))
    ask = additions.withColumn("key", clean).join(known, ["book", "key"], "left")
    ask = ask.withColumn("error", F.when(~F.coalesce(F.col("position").isin("start", "end"), F.lit(False)), "invalid position").when(F.col("held"), "label exists"))
    new = ask.where(F.col("error").isNull()).select("book", "label", F.when(F.col("position") == "start", 0).otherwise(2).alias("edge"), F.col("ord").cast("bigint").alias("k"), F.array().cast("array<int>").alias("path"))
    old = nav.select("book", "label", F.lit(1).alias("edge"), F.col("entry_id").cast("bigint").alias("k"), "path")
    rows = numbered(old.unionByName(new), ["book"], ["edge", "path", "k"], F.col("edge") * (1 << 40) + F.floor(F.coalesce(_top(), F.lit(0)) / 64), "play_order")
    return rows.select("book", "label", "play_order", F.lit(None).cast("string").alias("error")).unionByName(ask.where(F.col("error").isNotNull()).select("book", "label", F.lit(None).cast("bigint").alias("play_order"), "error"))


def preflight(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """(book, item_no, error): the first failed check of each book, none for a book that may be applied.

    `entries`: book, item_no, label, file, block, expect in pre-order; `blocks`: book, file_index, file, block, text of the reading order.
    At one entry the checks come in this order: file in the reading order, place not taken before, not before the entry before it,
    label, block in range, expected text given, expected text found at the place (white space aside).
    """
    files = blocks.groupBy("book", "file").agg(F.min("file_index").alias("file_index"), F.max("block").alias("last"))
    rows = entries.join(files, ["book", "file"], "left").join(blocks.select("book", "file", "block", "text"), ["book", "file", "block"], "left")
    place = F.when(F.col("file_index").isNotNull(), F.struct("file_index", "block"))
    bucket = F.floor(F.col("item_no") / BUCKET)
    rows = scan(rows, ["book"], ["item_no"], bucket, previous={"before": place})
    taken = rows.where(F.col("file_index").isNotNull()).groupBy("book", "file", "block").agg(F.min("item_no").alias("first"))
    rows = rows.join(taken, ["book", "file", "block"], "left")
    mark = lambda c: rules.apply("fingerprint", F.coalesce(F.col(c), F.lit("")))
    error = (
        F.when(F.col("file_index").isNull(), "missing spine file").when(F.col("first") < F.col("item_no"), "shared target block").when(F.struct("file_index", "block") < F.col("before"), "not in body reading order")
        .when(rules.apply("clean_text", F.coalesce("label", F.lit(""))) == "", "empty label").when((F.col("block") < 0) | (F.col("block") > F.col("last")) | F.col("block").isNull(), "block outside the file").when(mark("expect") == "", "no expected text")
        .when(~F.contains(mark("text"), mark("expect")), "stale expected text")
    )
    failed = rows.select("book", "item_no", error.alias("error")).where(F.col("error").isNotNull())
    return failed.groupBy("book").agg(F.min("item_no").alias("item_no"), F.min_by("error", "item_no").alias("error"))
