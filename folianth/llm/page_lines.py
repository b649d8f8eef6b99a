"""Expressions shared by the operators on scanned pages: text items, comparison keys of lines, page numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Full-width forms and their ordinary characters; the one is the other plus 0xFEE0.
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
#: A page is 1000 high; heads stand above TOP, foot lines below BOTTOM.
TOP, BOTTOM = 62.0, 900.0
# Forms of a page number, with the letters that scanning puts for digits.
PAGE_NUMBER = (
    r"(?iU)^[\s\p{Z}]*(?:"
    r"[-–—~·•.\[(【（〔|\s]*[0-9OolI|SBZ]{1,5}(?:\s?[0-9OolI|SBZ]){0,4}[-–—~·•.\])】）〕|\s]*"
    r"|[-–—·•\[(\s]*[ivxlc](?:\s?[ivxlc]){0,7}[-–—·•\])\s]*"
    r"|第\s*[0-9OolI|SBZ]{1,5}(?:\s?[0-9OolI|SBZ]){0,4}\s*[页頁]"
    r"|(?:page|p\.?|pg\.?)\s*[0-9OolI|SBZ]{1,5}"
    r"|[0-9OolI|SBZ](?:\s?[0-9OolI|SBZ]){0,4}\s*[/／]\s*[0-9OolI|SBZ](?:\s?[0-9OolI|SBZ]){0,4}"
    r")[\s\p{Z}]*$"
)
ITEM = "struct<text:string,text_level:string,bbox:array<double>,page_idx:int>"


def narrow(text: Column) -> Column:
    """Full-width forms as ordinary characters."""
    return F.translate(text, WIDE, NARROW)


def line_key(line: Column) -> Column:
    """Lines with equal keys differ only in digits, white space, letter case or character width."""
    return F.regexp_replace(F.lower(narrow(line)), r"(?U)[\p{Nd}\s\p{Z}\x{feff}\x{200b}]+", "")


def text_items(blocks: DataFrame, more_types: list[str] = []) -> DataFrame:  # noqa: B006
    """(block_id, book, source, seq, type, page, top, body, titled): items of type `text`, and of the types named besides.

    An item that can't be parsed, or whose `text` is null, has a null body. A missing or odd `bbox` gives a null top.
    """
    item = F.from_json("item", ITEM)
    held = blocks.where(F.col("type").isin("text", *more_types)).select("block_id", "book", "source", "seq", "type", "page_idx", item.alias("i"))
    return held.select(
        "block_id", "book", "source", "seq", "type", F.coalesce("i.page_idx", "page_idx").alias("page"),
        F.when(F.size("i.bbox") == 4, F.element_at("i.bbox", 2)).alias("top"), F.col("i.text").alias("body"), F.col("i.text_level").isNotNull().alias("titled"),
    )
