"""Search specifications resolved to exact block coordinates.

Where an entry could match is found first, for all books at once, by equi-joins (on equal keys, or on the first characters of the
search text). What remains is the cursor: an entry is looked for after the hit of the entry before it. That is a fold over
the candidate places of one book, which are few numbers, not text.

Entries follow in pre-order. An entry with file and block sets the cursor. `exact` asks for a window equal to one of the texts,
otherwise the window must contain all of them. Without a hit the entry comes out with an error and the cursor stays; null or
empty searches fall back to the label; an entry without any key is an error.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folianth.functions import rules
from folianth.operators.contains import contains_join
from folianth.operators.ordered import BUCKET, scan

RESOLVED = "book string, entry_id bigint, seq int, file_index int, block int, error string"


def windows(blocks: DataFrame, sizes: list[int]) -> DataFrame:
    """(book, file_index, block, size, key): keys of `size` blocks that follow each other in one file."""
    out = None
    for n in sizes:
        rows = blocks.select("book", "file_index", "block", "text")
        for k in range(1, n):
            rows = scan(rows, ["book", "file_index"], ["block"], F.floor(F.col("block") / BUCKET), following={f"t{k}": F.col("text" if k == 1 else f"t{k - 1}")})
        text = F.concat_ws(" ", "text", *(f"t{k}" for k in range(1, n)))
        one = rows.select("book", "file_index", "block", F.lit(n).alias("size"), rules.apply("key_resolve", text).alias("key"))
        out = one if out is None else out.unionByName(one)
    return out


def candidates(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """(entry_id, file_index, block): every place where an entry's search would match, wherever the cursor stands."""
    searched = entries.where(F.col("block").isNull() | F.col("file_index").isNull())
    texts = F.filter(F.coalesce("search", F.array().cast("array<string>")), lambda x: F.length(x) > 0)
    keys = F.filter(F.transform(F.when(F.size(texts) > 0, texts).otherwise(F.array("label")), lambda x: rules.apply("key_resolve", x)), lambda x: F.length(x) > 0)
    wanted = searched.select("book", "entry_id", F.coalesce("window", F.lit(1)).alias("size"), F.coalesce("exact", F.lit(False)).alias("exact"), F.array_distinct(keys).alias("keys"))
    sizes = sorted(r[0] for r in wanted.select("size").distinct().collect()) or [1]
    shown = windows(blocks, sizes).withColumn("place", F.struct("file_index", "block"))
    each = wanted.select("book", "entry_id", "size", "exact", F.size("keys").alias("n"), F.explode("keys").alias("needle"))
    equal = each.where("exact").join(shown.withColumnRenamed("key", "needle"), ["book", "size", "needle"]).select("entry_id", "place")
    held = contains_join(each.where(~F.col("exact")), "needle", shown.select("book", "size", "place", "key"), "key", "place", on=["book", "size"])
    held = held.groupBy("entry_id", "place", "n").agg(F.count_distinct("needle").alias("found")).where("found = n").select("entry_id", "place")
    return equal.unionByName(held).distinct().select("entry_id", "place.file_index", "place.block")


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """The cursor over one book: entries in order, each with its sorted candidate places."""
    cursor, out = (0, 0), []
    first = True
    for r in pdf.sort_values(["seq", "entry_id"]).itertuples(index=False):
        if first:
            cursor, first = (int(r.book_file or 0) if r.book_file == r.book_file else 0, int(r.book_block or 0) if r.book_block == r.book_block else 0), False
        if r.block == r.block and r.block is not None and r.file_index == r.file_index and r.file_index is not None:
            place, error = (int(r.file_index), int(r.block)), None
        else:
            at = int(r.start_file) if r.start_file == r.start_file and r.start_file is not None else int(r.book_file) if r.book_file == r.book_file and r.book_file is not None else 0
            start = (max(cursor[0], at), cursor[1] if max(cursor[0], at) == cursor[0] else 0)
            last = int(r.max_file) if r.max_file == r.max_file and r.max_file is not None else 1 << 40
            hits = sorted((int(p["file_index"]), int(p["block"])) for p in (r.places if r.places is not None else ()))
            hits = [h for h in hits if h >= start and h[0] <= last]
            n = int(r.occurrence) if r.occurrence == r.occurrence and r.occurrence else 1
            place, error = (hits[n - 1], None) if len(hits) >= n else (None, f"could not resolve after {start}")
        if place is not None:
            cursor = (place[0], place[1] + 1)
        out.append((r.book, r.entry_id, r.seq, place[0] if place else None, place[1] if place else None, error))
    return pd.DataFrame(out, columns=["book", "entry_id", "seq", "file_index", "block", "error"]).astype({"file_index": "Int32", "block": "Int32", "seq": "Int32"})


def resolve(entries: DataFrame, blocks: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """(book, entry_id, seq, file_index, block, error) of every entry of a named book.

    `entries`: book, entry_id, seq, label, search, exact, occurrence, start_file, max_file, window, file_index, block;
    `blocks`: book, file_index, block, text; `books`: book, start_file, start_block, exact as defaults.
    """
    e = entries.where(F.col("book").isNotNull())
    if books is not None:
        e = e.join(books.select("book", F.col("start_file").alias("book_file"), F.col("start_block").alias("book_block"), F.col("exact").alias("book_exact")), "book", "left").withColumn("exact", F.coalesce("exact", "book_exact")).drop("book_exact")
    else:
        e = e.withColumns({"book_file": F.lit(None).cast("int"), "book_block": F.lit(None).cast("int")})
    # a place outside the files that an entry may look in can never be its hit
    bounds = e.select("entry_id", F.coalesce("start_file", "book_file", F.lit(0)).alias("low"), F.coalesce("max_file", F.lit(2**31 - 1)).alias("high"))
    inside = candidates(e, blocks).join(bounds, "entry_id").where(F.col("file_index").between(F.col("low"), F.col("high")))
    places = inside.groupBy("entry_id").agg(F.collect_list(F.struct("file_index", "block")).alias("places"))
    rows = e.select("book", "entry_id", "seq", "occurrence", "start_file", "max_file", "file_index", "block", "book_file", "book_block").join(places, "entry_id", "left")
    return rows.groupBy("book").applyInPandas(_follow, RESOLVED)
