"""Edits of navigation trees against plain lists, with nulls, ties, repeated rows, empty tables and clashing columns."""

import random

from folianth.operators import edits

SCHEMA = "book string, entry_id bigint, path array<int>, label string, src string"


def tree(rng, book, base):
    rows, stack = [], [[]]
    for _ in range(rng.randint(1, 14)):
        above = rng.choice(stack)
        path = [*above, sum(1 for r in rows if r[2][:-1] == above)]
        rows.append((book, base + len(rows), path, rng.choice(["A", "B", "C", None]) if rng.random() < 0.3 else f"L{base + len(rows)}", rng.choice("xyz")))
        stack.append(path)
    return sorted(rows, key=lambda r: r[2])


def test_pruning_and_deleting_equal_plain_lists(spark):
    rng = random.Random(5)
    books = {f"b{k}": tree(rng, f"b{k}", 100 * k) for k in range(12)}
    rows = [r for b in books.values() for r in b]
    out = {r[1] for r in rows if rng.random() < 0.4}
    nav = spark.createDataFrame(rows, SCHEMA)
    below = lambda p, gone: any(p[: len(g)] == g for g in gone)
    for least in (1, 3):
        got = {}
        for r in edits.pruned(nav, spark.createDataFrame([(i,) for i in out] * 2, "entry_id bigint"), least).collect():
            got.setdefault(r.book, []).append((r.play_order, r.entry_id))
        for book, own in books.items():
            gone = [r[2] for r in own if r[1] in out]
            kept = own if len(own) - len(gone) < least else [r for r in own if not below(r[2], gone)]
            assert [i for _, i in sorted(got.get(book, []))] == [r[1] for r in kept]
    named = spark.createDataFrame([("b1", "A", None), ("b1", None, "x"), ("b2", None, None)], "book string, label string, src string")
    got = {r.entry_id for r in edits.deleted(nav, named).collect()}
    gone = [r[2] for r in books["b1"] if r[3] == "A" or r[4] == "x"]
    assert got == {r[1] for r in rows if r[0] != "b1" or not below(r[2], gone)}


def test_empty_and_clashing(spark):
    nav = spark.createDataFrame([("b", 1, [0], "A", "x"), (None, 2, [0], "A", "x"), ("b", 3, None, None, None)], SCHEMA)
    none = nav.limit(0)
    moves = spark.createDataFrame([("b", 1, "A", "A"), (None, 1, "A", "A")], "book string, ord int, label string, before string")
    assert edits.moved(none, moves).count() == 0 and edits.moved(nav, moves.limit(0)).count() == 3
    assert edits.pruned(none, nav.select("entry_id"), 1).count() == 0 and edits.deleted(nav, none.select("book", "label", "src")).count() == 3
    adds = spark.createDataFrame([("b", 1, "end", "Z", "clash"), ("b", 2, None, "Y", "clash")], "book string, ord int, position string, label string, path string")
    got = {(r.label, r.play_order, r.error) for r in edits.edged(nav.where("book = 'b'"), adds).collect()}
    assert got == {(None, 1, None), ("A", 2, None), ("Z", 3, None), ("Y", None, "invalid position")}
    e = spark.createDataFrame([("b", 1, "A", "f", 0, "x")], "book string, item_no int, label string, file string, block int, expect string")
    blocks = spark.createDataFrame([], "book string, file_index int, file string, block int, text string")
    assert [r.error for r in edits.preflight(e, blocks).collect()] == ["missing spine file"] and edits.preflight(e.limit(0), blocks).count() == 0
