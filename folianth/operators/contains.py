"""Joins on containment without comparing all pairs.

A needle can only stand in a text that holds its first few characters. The texts' windows of that length meet the needles'
beginnings in an equi-join, and only those pairs are compared. The beginnings are written first, so that their size is known: as long
as they are small the planner sieves the windows by them where they arise, and only windows that some needle begins with are shuffled.
Nothing is capped: every containing pair comes out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folianth.sources.tables import written

GRAM = 6


def contains_join(needles: DataFrame, needle: str, texts: DataFrame, text: str, text_id: str, on: list[str] | None = None, gram: int = GRAM) -> DataFrame:
    """Rows of `needles` with the rows of `texts` whose `text` contains `needle`, within equal `on` columns.

    `text_id` names a text; only it travels with the windows, the texts meet the candidates afterwards. Null and empty needles
    match nothing. Needles shorter than `gram` use windows of their own length. The other columns of both sides must differ
    in name; `on` columns come once.
    """
    on = on or []
    few = F.least(F.length(needle), F.lit(gram))
    left = needles.where(F.length(needle) > 0).withColumn("_g", F.substring(F.col(needle), F.lit(1), few))
    sizes = sorted(r[0] for r in left.select(F.length("_g")).distinct().collect()) or [gram]  # at most `gram` numbers
    # a look-ahead that takes nothing gives every window in one pass; the text is evaluated once
    every = lambda t: F.array_distinct(F.flatten(F.array(*(F.regexp_extract_all(t, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) for n in sizes))))
    windows = texts.where(F.length(text) > 0).select(*on, text_id, F.explode(F.element_at(F.transform(F.array(F.col(text)), every), 1)).alias("_g"))
    begins = written(left.select(*on, "_g").distinct(), "needle-begins")
    met = left.join(windows.join(begins, [*on, "_g"], "left_semi"), [*on, "_g"]).drop("_g")
    return met.join(texts, [*on, text_id]).where(F.contains(F.col(text), F.col(needle)))
