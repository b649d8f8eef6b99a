"""Lookups around a place: snippets, locators near a match, ranges of blocks, ordered comparison, nesting under headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folianth.functions import classify, rules
from folianth.operators.contains import contains_join
from folianth.operators.ordered import BUCKET, numbered, scan

AFTER = rf"^{rules.SP}*{rules.LOCATOR_LOW}(?:{rules.SP}|$)"
BEFORE = rf"(?:^|{rules.SP}){rules.DIGIT}{{1,4}}{rules.SP}*$"
NEAR = rf"{rules.LOCATOR_LOW}(?:{rules.SP}|$)"


def snippet(text: Column, offset: Column, before: int = 80, after: int = 220) -> Column:
    """The plain text around an offset (from 0); an offset below 0 gives the beginning."""
    start = F.greatest(offset - before, F.lit(0))
    return rules.apply("tags_to_space", F.substring(text, start + 1, F.greatest(offset, F.lit(0)) + after - start))


def fragment_offset(page: Column, fragment: Column, label: Column, repair: bool = False) -> Column:
    """Where the element with the id begins; without an id where the label stands, else 0.

    An id that is missing gives -1 to an audit; for a `repair` the label is looked for then too.
    """
    one = F.greatest(F.instr(page, F.concat(F.lit('id="'), fragment, F.lit('"'))), F.instr(page, F.concat(F.lit("id='"), fragment, F.lit("'"))))
    plain = F.instr(rules.apply("tags_to_space", page), label)
    by_id = (F.length(fragment) > 0) & (one > 0) if repair else F.length(fragment) > 0
    return F.when(by_id, one - 1).when((F.length(label) > 0) & (plain > 0), plain - 1).otherwise(0)


def locator_after(text: Column, end: Column) -> Column:
    """Leader dots and a page number follow within 120 characters."""
    return rules.apply([("<[^>]+>", " "), rules.UNESCAPE], F.substring(text, end + 1, F.lit(120))).rlike(AFTER)


def locator_before(text: Column, start: Column) -> Column:
    """A page number stands within the 30 characters before."""
    at = F.greatest(start - 30, F.lit(0))
    return rules.apply([("<[^>]+>", " "), rules.UNESCAPE], F.substring(text, at + 1, start - at)).rlike(BEFORE)


def locator_near(text: Column, start: Column, end: Column) -> Column:
    """Leader dots and a page number stand from the match to 140 characters after it."""
    return rules.apply([("<[^>]+>", " "), rules.UNESCAPE], F.substring(text, start + 1, end - start + 140)).rlike(NEAR)


def locator_around(text: Column, start: Column, end: Column) -> Column:
    """A locator or a leading page number stands from 40 characters before the match to 160 after it."""
    at = F.greatest(start - 40, F.lit(0))
    context = rules.apply("tags_to_space", F.substring(text, at + 1, end + 160 - at))
    return context.rlike(rules.LOCATOR_LOW) | context.rlike(classify.LEADING_PAGE)


def likely_printed(label: Column, file_index: Column, near: Column) -> Column:
    """An entry of a printed contents page: its label carries a locator, or it leads to one of the first files where a contents word or a locator is near."""
    head = F.substring(near, 1, 120).contains("目录") | F.substring(near, 1, 220).rlike(rules.LOCATOR)
    return label.rlike(rules.LOCATOR) | ((file_index <= 2) & head)


def next_label_near(text: Column, end: Column, label: Column) -> Column:
    """The next label's key (three characters at least) stands within 360 characters."""
    key = rules.apply("key_printed", label)
    return (F.length(key) >= 3) & F.contains(rules.apply("key_printed", F.substring(text, end + 1, F.lit(360))), key)


def range_expand(ranges: DataFrame, blocks: DataFrame) -> DataFrame:
    """The blocks of each range, ends included; `ranges`: book, range_id, start and stop coordinates; `blocks`: book, file_index, block, text.

    A range meets the files it spans by number in an equi-join; only the blocks of its end files are compared by place.
    """
    spans = ranges.select("book", "range_id", "start_file", "start_block", "stop_file", "stop_block", F.explode(F.sequence("start_file", "stop_file")).alias("file_index"))
    met = spans.join(blocks, ["book", "file_index"])
    place = F.struct("file_index", "block")
    return met.where((place >= F.struct(F.col("start_file").alias("file_index"), F.col("start_block").alias("block"))) & (place <= F.struct(F.col("stop_file").alias("file_index"), F.col("stop_block").alias("block")))).select("book", "range_id", "file_index", "block", "text")


def nth_target(wanted: DataFrame, targets: DataFrame) -> DataFrame:
    """The n-th target with a label, white space aside; `wanted`: book, label, occurrence; `targets`: book, seq, label, pos.

    Without an occurrence a label must be the only one; else the row comes out with an error.
    """
    key = lambda c: rules.apply("fingerprint", F.col(c))
    rows = targets.select("book", "seq", "pos", key("label").alias("key"))
    rows = numbered(rows, ["book", "key"], ["seq"], F.floor(F.col("seq") / BUCKET), "n")
    many = rows.groupBy("book", "key").agg(F.max("n").alias("many"))
    asked = wanted.select("book", "label", "occurrence", key("label").alias("key")).join(many, ["book", "key"], "left").withColumn("n", F.coalesce("occurrence", F.lit(1)).cast("bigint"))
    met = asked.join(rows, ["book", "key", "n"], "left")
    error = F.when(F.col("many").isNull(), "no such label").when(F.col("occurrence").isNull() & (F.col("many") > 1), "ambiguous label").when(F.col("pos").isNull(), "no such occurrence")
    return met.select("book", "label", "occurrence", F.when(error.isNull(), F.col("pos")).alias("pos"), error.alias("error"))


def ordered_zip(expected: DataFrame, actual: DataFrame, columns: list[str]) -> DataFrame:
    """Row by row in order of `seq`: where the i-th expected and the i-th actual row of a book differ, or one side is short."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        n = numbered(df, ["book"], ["seq"], F.floor(F.col("seq") / BUCKET), "i")
        return n.select("book", "i", F.struct(*columns).alias(tag))

    both = side(expected, "expected").join(side(actual, "actual"), ["book", "i"], "full")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual")))


def tree_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries (book, path, label, file, block) that only one of two trees has; expected texts don't count."""
    columns = ["book", "path", "label", "file", "block"]
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def nested_under(blocks: DataFrame, levels: list[str]) -> DataFrame:
    """Each heading block with the headings above it: for each level the last heading of it that no higher one has closed.

    `blocks`: book, seq, tag, text; the result adds a column for each level in `levels` (from the highest).
    """
    out = blocks
    bucket = F.floor(F.col("seq") / BUCKET)
    for k, level in enumerate(levels):
        out = scan(out, ["book"], ["seq"], bucket, max_before={f"_at_{level}": F.when(F.col("tag") == level, F.struct("seq", "text"))})
        if k:
            above = [F.coalesce(F.col(f"_at_{x}")["seq"], F.lit(-1)) for x in levels[:k]]
            out = out.withColumn(f"_at_{level}", F.when(F.col(f"_at_{level}")["seq"] > (F.greatest(*above) if len(above) > 1 else above[0]), F.col(f"_at_{level}")))
    return out.select(*blocks.columns, *(F.when(~F.col("tag").isin(levels[: k + 1]), F.col(f"_at_{x}")["text"]).alias(x) for k, x in enumerate(levels)))


def numbered_titles(lines: DataFrame) -> DataFrame:
    """Titles numbered 1, 2, 3 ... in the text of a printed list: a number begins a title only if it is the next expected one.

    `lines`: book, seq, text. A line that begins with n begins title n if exactly the titles 1 to n-1 have begun before, that is
    if the largest number that could be reached before it is n-1; other lines continue the open title. Result: book, no, title.
    """
    import pandas as pd

    marked = lines.withColumn("n", F.regexp_extract("text", rf"^{rules.SP}*([0-9]{{1,4}})[.、．{rules.SP[1:-1]}]", 1).try_cast("int"))
    numbers = marked.where(F.col("n").isNotNull()).select("book", "seq", "n")

    def follow(pdf: "pd.DataFrame") -> "pd.DataFrame":
        want, out = 1, []
        for r in pdf.sort_values("seq").itertuples(index=False):
            if r.n == want:
                out.append((r.book, r.seq, want))
                want += 1
        return pd.DataFrame(out, columns=["book", "seq", "no"])

    starts = numbers.groupBy("book").applyInPandas(follow, "book string, seq bigint, no int")  # numbers only, no text
    rows = marked.join(starts, ["book", "seq"], "left")
    rows = scan(rows, ["book"], ["seq"], F.floor(F.col("seq") / BUCKET), max_before={"before": F.col("no")}).withColumn("no", F.coalesce("no", "before"))
    parts = rows.where(F.col("no").isNotNull()).groupBy("book", "no").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda x: x["text"]), "")
    return parts.select("book", "no", rules.apply([(rf"^{rules.SP}*[0-9]{{1,4}}[.、．]?", ""), *rules.STRIP], text).alias("title"))


def body_targets(titles: DataFrame, blocks: DataFrame, wrap: bool = False) -> DataFrame:
    """(entry_id, file_index, block): for each title the first body block after its place that holds its key and is no printed line.

    `titles`: book, entry_id, file_index, block, label; `blocks`: book, file_index, block, text. With `wrap` the search goes on from the first
    file after the last, and of the blocks of a file one that holds the label as it stands comes before one that only holds its key.
    """
    asked = titles.select("book", "entry_id", F.struct(F.col("file_index"), F.col("block")).alias("from"), rules.apply("label_repair", F.col("label")).alias("raw"), rules.apply("key_anchor", F.col("label")).alias("needle")).where(F.length("needle") >= 2)
    body = blocks.where(~classify.toc_line(F.col("text")) & ~classify.printed_label(F.col("text"))).select("book", F.struct("file_index", "block").alias("place"), F.col("text").alias("body"), rules.apply("key_anchor", F.col("text")).alias("key"))
    met = contains_join(asked, "needle", body, "key", "place", on=["book"])
    if wrap:
        count = blocks.groupBy("book").agg((F.max("file_index") + 1).alias("files"))
        rank = F.struct(wrapped_order(F.col("place.file_index"), F.col("from.file_index") + 1, F.col("files")), F.when(F.contains("body", "raw"), 0).otherwise(1), F.col("place"))
        return met.join(count, "book").groupBy("entry_id").agg(F.min_by("place", rank).alias("place")).select("entry_id", "place.file_index", "place.block")
    met = met.where(F.col("place") > F.col("from"))
    return met.groupBy("entry_id").agg(F.min("place").alias("place")).select("entry_id", "place.file_index", "place.block")


def wrapped_order(index: Column, start: Column, count: Column) -> Column:
    """The rank of a file when a search begins at `start` and wraps round."""
    return F.pmod(index - start + count, count)


def wrapped_search(searches: DataFrame, docs: DataFrame) -> DataFrame:
    """(book, search_id, file_index, error): the first file, from the given one on and round, whose key holds the search's key.

    `searches`: book, search_id, search, start_index; `docs`: book, file_index, text. A search without a key or a hit is an error row.
    """
    asked = searches.withColumn("needle", rules.apply("key_manual", F.col("search")))
    held = docs.select("book", "file_index", rules.apply("key_manual", F.col("text")).alias("key"))
    count = docs.groupBy("book").agg((F.max("file_index") + 1).alias("files"))
    met = contains_join(asked.select("book", "search_id", "start_index", "needle"), "needle", held, "key", "file_index", on=["book"]).join(count, "book")
    first = met.groupBy("search_id").agg(F.min_by("file_index", wrapped_order(F.col("file_index"), F.col("start_index"), F.col("files"))).alias("file_index"))
    return searches.select("book", "search_id").join(first, "search_id", "left").select("book", "search_id", "file_index", F.when(F.col("file_index").isNull(), "not found").alias("error"))


def later_duplicates(entries: DataFrame) -> DataFrame:
    """Entries of which a later one of the same book has an equal, holding or held key, or the same leading ordinal; `entries`: book, entry_id, seq, label.

    Pairs are of different keys of a book, each with its last place, not of entries.
    """
    keyed = entries.select("book", "entry_id", "seq", rules.apply("key_printed", F.col("label")).alias("key"), rules.ordinal_prefix(F.col("label")).alias("ordinal"))
    keys = keyed.where(F.length("key") > 0).groupBy("book", "key").agg(F.max("seq").alias("last"))
    met = contains_join(keys.select("book", F.col("key").alias("part"), F.col("last").alias("last_part")), "part", keys, "key", "key", on=["book"])
    reach = met.select("book", "key", F.col("last_part").alias("last")).unionByName(met.select("book", F.col("part").alias("key"), "last")).groupBy("book", "key").agg(F.max("last").alias("last"))
    ordinals = keyed.where(F.length("ordinal") > 0).groupBy("book", "ordinal").agg(F.max("seq").alias("last"))
    by_key = keyed.join(reach, ["book", "key"]).where(F.col("seq") < F.col("last")).select("book", "entry_id")
    by_ordinal = keyed.join(ordinals, ["book", "ordinal"]).where(F.col("seq") < F.col("last")).select("book", "entry_id")
    return by_key.unionByName(by_ordinal).distinct()


def first_holder(names: DataFrame, markers: DataFrame) -> DataFrame:
    """(name, marker, note): for each name the first marker (by `ord`) that it holds; names without one have nulls.

    `names`: name; `markers`: ord, marker, note. A null or empty marker is held by nothing.
    """
    met = contains_join(markers.select("ord", "marker", "note"), "marker", names.select("name").distinct().withColumn("text", F.col("name")), "text", "name")
    first = met.groupBy("name").agg(F.min_by(F.struct("marker", "note"), "ord").alias("m"))
    return names.join(first, "name", "left").select("name", "m.marker", "m.note")


def match_specs(books: DataFrame, specs: DataFrame) -> DataFrame:
    """(book, spec): the first spec (by `ord`) of which the file name is the book's, or the stem a part of the book's stem; null without one.

    `books`: book; `specs`: ord, file.
    """
    stem = lambda c: F.regexp_replace(c, r"(?<=.)\.[^.]*$", "")
    exact = books.join(specs.withColumnRenamed("file", "book"), "book").select("book", "ord", F.col("book").alias("spec"))
    held = contains_join(specs.select("ord", "file", stem(F.col("file")).alias("needle")), "needle", books.select("book").distinct().withColumn("stem", stem(F.col("book"))), "stem", "book").select("book", "ord", F.col("file").alias("spec"))
    return books.join(exact.unionByName(held).groupBy("book").agg(F.min_by("spec", "ord").alias("spec")), "book", "left").select("book", "spec")


def first_by_order(rows: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """The first `limit` rows of each key, as a report caps them."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= limit).drop("_k")
