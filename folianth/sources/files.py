"""Plain files in and out: layout JSON, CSV with a byte-order mark, books by name or pattern."""

from __future__ import annotations

import csv
import json
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folianth.operators.contains import contains_join


def read_layout(spark: SparkSession, path: str, pattern: str = "*_content_list*.json") -> DataFrame:
    """(path, part, prefix, seq, item, error): the items of layout files in order; a file holds a list of items or a list of pages of items.

    Files of several parts are numbered in order of their names; `prefix` (`p001`) keeps their pictures apart. A file that holds neither
    gives one row with an error.
    """
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select(F.input_file_name().alias("path"), F.regexp_replace("value", "^﻿", "").alias("v"))
    parts = files.select("path").distinct().withColumn("part", F.dense_rank().over(Window.orderBy("path")))  # a row for each file
    pages = F.from_json("v", "array<array<variant>>")
    flat = F.from_json("v", "array<variant>")
    items = F.when(F.col("v").rlike(r"^\s*\[\s*\["), F.flatten(pages)).when(F.col("v").rlike(r"^\s*\["), flat)
    held = files.select("path", items.alias("items"))
    rows = held.where(F.col("items").isNotNull()).select("path", F.posexplode(F.transform("items", lambda x: F.to_json(x))).alias("seq", "item"), F.lit(None).cast("string").alias("error")).where(F.col("item").startswith("{"))
    bad = held.where(F.col("items").isNull()).select("path", F.lit(None).cast("int").alias("seq"), F.lit(None).cast("string").alias("item"), F.lit("not a list of items").alias("error"))
    return rows.unionByName(bad).join(parts, "path").select("path", "part", F.format_string("p%03d", "part").alias("prefix"), "seq", "item", "error")


def spec_names(specs: DataFrame) -> DataFrame:
    """(file, n, error): the book names of review specs; one that is empty, or that several books carry, is an error. `specs`: file."""
    n = specs.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return n.select("file", "n", F.when(F.coalesce(F.trim("file"), F.lit("")) == "", "empty file name").when(F.col("n") > 1, "file name not unique").alias("error"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A table with a head line; a leading byte-order mark is no part of the first name."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")})


def write_report(df: DataFrame, path: str) -> int:
    """A small report as one CSV file with a byte-order mark, streamed row by row; the rows written."""
    n = 0
    with open(f"{path}.part", "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for r in df.toLocalIterator():
            out.writerow(["" if v is None else v for v in r])
            n += 1
    os.replace(f"{path}.part", path)
    return n


def glob_pattern(pattern: Column) -> Column:
    """The regular expression of a file pattern: `*`, `?` and `[...]` as in a shell, everything else as it stands."""
    out = F.regexp_replace(pattern, r"([.\\+^$(){}|])", r"\\$1")
    out = F.regexp_replace(F.regexp_replace(out, r"\[!", "[^"), r"\*", ".*")
    return F.concat(F.lit("(?s)^"), F.regexp_replace(out, r"\?", "."), F.lit("$"))


def find_books(wanted: DataFrame, books: DataFrame) -> DataFrame:
    """(pattern, book, matches): the book of each pattern; the exact name wins, else exactly one name must match (book is null otherwise).

    A name with brackets matches itself. Other patterns meet the names by their longest plain piece (a containment join); a pattern
    without one, such as `*`, meets all names.
    """
    named = books.select("book").where(F.col("book").isNotNull()).distinct()
    asked = wanted.select("pattern").distinct()
    exact = asked.join(named.withColumnRenamed("book", "pattern"), "pattern", "left_semi").select("pattern", F.col("pattern").alias("book"), F.lit(1).cast("bigint").alias("matches"))
    rest = asked.join(exact, "pattern", "left_anti")
    plain = F.array_sort(F.split(F.regexp_replace("pattern", r"\[[^\]]*\]", "*"), r"[*?]"), lambda a, b: F.length(b) - F.length(a))
    rest = rest.withColumns({"piece": F.element_at(plain, 1), "regex": glob_pattern(F.col("pattern"))})
    met = contains_join(rest, "piece", named.withColumn("name", F.col("book")), "name", "book").where(F.regexp_like("book", "regex"))
    loose = met.groupBy("pattern").agg(F.count(F.lit(1)).alias("matches"), F.min("book").alias("one"))
    whole = named.agg(F.count(F.lit(1)).alias("all_books"), F.min("book").alias("any_book")).collect()[0]
    out = rest.join(loose, "pattern", "left").withColumns({"matches": F.when((F.col("piece") == "") & F.col("pattern").contains("*"), F.lit(whole["all_books"])).otherwise(F.coalesce("matches", F.lit(0))), "one": F.when(F.col("piece") == "", F.lit(whole["any_book"])).otherwise(F.col("one"))})
    return exact.unionByName(out.select("pattern", F.when(F.col("matches") == 1, F.col("one")).alias("book"), F.col("matches").cast("bigint").alias("matches")))


def book_json(nav: DataFrame) -> DataFrame:
    """(book, spec): the reviewed tree of each book as JSON text; the tree of one book is one value.

    `nav`: book, path, label, file, block, expect; an entry whose parent is missing hangs under the nearest one above it.
    """
    import pandas as pd

    def make(pdf: "pd.DataFrame") -> "pd.DataFrame":
        top: list[dict] = []
        open_: list[tuple[list, dict]] = []
        for r in sorted(pdf.itertuples(index=False), key=lambda r: list(r.path)):
            entry = {"label": r.label, "file": r.file, "block": None if r.block is None or r.block != r.block else int(r.block), "expect": r.expect or ""}
            while open_ and list(r.path)[: len(open_[-1][0])] != open_[-1][0]:
                open_.pop()
            (open_[-1][1].setdefault("children", []) if open_ else top).append(entry)
            open_.append((list(r.path), entry))
        return pd.DataFrame([(pdf["book"].iloc[0], json.dumps({"file": pdf["book"].iloc[0], "entries": top}, ensure_ascii=False))], columns=["book", "spec"])

    rows = nav.where(F.col("book").isNotNull() & F.col("path").isNotNull()).select("book", "path", "label", "file", "block", "expect")
    return rows.groupBy("book").applyInPandas(make, "book string, spec string")
