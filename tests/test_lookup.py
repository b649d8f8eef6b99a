import json
import random

from pyspark.sql import functions as F

from folianth.operators import lookup as L
from folianth.operators.nested import nodes
from folianth.sources import files


def test_places_in_text(spark):
    page = '<p>目录</p><p id="a">第三章 涨潮…… 12</p><p>第五章</p>'
    df = spark.createDataFrame([(page, "a", "x"), (page, "no", "x"), (page, "", "第五章"), (page, "", "")], "page string, fragment string, label string")
    got = [r[0] for r in df.select(L.fragment_offset(F.col("page"), F.col("fragment"), F.col("label"))).collect()]
    assert got[0] == page.index('id="a"') and got[1] == -1 and got[2] > 0 and got[3] == 0
    text = "begin 第三章 涨潮…… 12 第五章 退潮…… 15 end"
    at = text.index("第三章 涨潮")
    r = spark.createDataFrame([(text, at, at + 6)], "t string, a int, b int").select(
        L.locator_after(F.col("t"), F.col("b")), L.locator_before(F.col("t"), F.col("a")), L.locator_before(F.col("t"), F.lit(text.index("第五章"))), L.locator_near(F.col("t"), F.col("a"), F.col("b")), L.next_label_near(F.col("t"), F.col("b"), F.lit("第五章 退潮")), L.snippet(F.col("t"), F.col("a"), 6, 3),
    ).collect()[0]
    assert tuple(r) == (True, False, True, True, True, "begin 第三章")


def test_ranges_occurrences_and_zips(spark):
    blocks = spark.createDataFrame([("b", f, k, f"{f}.{k}") for f in range(3) for k in range(4)], "book string, file_index int, block int, text string")
    ranges = spark.createDataFrame([("b", 1, 0, 2, 2, 1), ("b", 2, 1, 1, 1, 1)], "book string, range_id int, start_file int, start_block int, stop_file int, stop_block int")
    got = {(r.range_id, r.text) for r in L.range_expand(ranges, blocks).collect()}
    assert got == {(1, x) for x in ("0.2", "0.3", "1.0", "1.1", "1.2", "1.3", "2.0", "2.1")} | {(2, "1.1")}
    targets = spark.createDataFrame([("b", 1, "A b", 10), ("b", 2, "Ab", 20), ("b", 3, "c", 30)], "book string, seq int, label string, pos int")
    wanted = spark.createDataFrame([("b", "a b", None), ("b", "A b", None), ("b", "A b", 2), ("b", "A b", 3), ("b", "c", None)], "book string, label string, occurrence int")
    rows = {(r.label, r.occurrence): (r.pos, r.error) for r in L.nth_target(wanted, targets).collect()}
    assert rows == {("a b", None): (None, "no such label"), ("A b", None): (None, "ambiguous label"), ("A b", 2): (20, None), ("A b", 3): (None, "no such occurrence"), ("c", None): (30, None)}
    other = targets.where("seq < 3").withColumn("pos", F.when(F.col("seq") == 2, 21).otherwise(F.col("pos")))
    assert sorted(r.i for r in L.ordered_zip(targets, other, ["label", "pos"]).collect()) == [2, 3]


def test_nesting_and_numbered_titles(spark):
    rng = random.Random(6)
    rows = [("b", i, rng.choice(["h1", "h2", "h3", "p"]), f"t{i}") for i in range(200)]
    got = {r.seq: (r.h1, r.h2) for r in L.nested_under(spark.createDataFrame(rows, "book string, seq int, tag string, text string"), ["h1", "h2"]).collect()}
    h1 = h2 = None
    for _, i, tag, text in rows:
        want = (None, None) if tag == "h1" else (h1, None) if tag == "h2" else (h1, h2)
        assert got[i] == want
        h1, h2 = (text, None) if tag == "h1" else (h1, text) if tag == "h2" else (h1, h2)
    lines = ["intro", "1. one", "1. again", "3. no", "2. two", "tail", "3、three"]
    df = spark.createDataFrame([("b", i, x) for i, x in enumerate(lines)], "book string, seq bigint, text string")
    assert {r.no: r.title for r in L.numbered_titles(df).collect()} == {1: "one1. again3. no", 2: "twotail", 3: "three"}


def test_trees_duplicates_and_targets(spark):
    a = spark.createDataFrame([("b", [0], "x", "f", 1), ("b", [1], "y", "f", 2)], "book string, path array<int>, label string, file string, block int")
    b = a.withColumn("block", F.when(F.col("label") == "y", 3).otherwise(F.col("block")))
    assert sorted(r.side for r in L.tree_differences(a, b).collect()) == ["left", "right"] and L.tree_differences(a, a).count() == 0
    e = spark.createDataFrame([("b", 1, 1, "第三章 甲"), ("b", 2, 2, "乙乙"), ("b", 3, 3, "第三章 丙"), ("b", 4, 4, "乙 乙"), ("c", 5, 1, "乙乙")], "book string, entry_id bigint, seq int, label string")
    assert sorted(r.entry_id for r in L.later_duplicates(e).collect()) == [1, 2]
    blocks = spark.createDataFrame([("b", 0, 0, "甲乙丙……3"), ("b", 0, 1, "甲乙"), ("b", 1, 0, "x 甲 乙丙"), ("b", 1, 1, "甲乙丙")], "book string, file_index int, block int, text string")
    titles = spark.createDataFrame([("b", 9, 0, 0, "甲乙丙"), ("b", 8, 1, 1, "甲乙丙")], "book string, entry_id bigint, file_index int, block int, label string")
    assert [tuple(r) for r in L.body_targets(titles, blocks).collect()] == [(9, 1, 0)]
    assert L.first_by_order(e, ["book"], ["seq"], 2).count() == 3 and spark.range(3).select(L.wrapped_order(F.col("id"), F.lit(2), F.lit(3))).collect()[0][0] == 1


def test_files(spark, tmp_path):
    (tmp_path / "in" / "p1").mkdir(parents=True)
    (tmp_path / "in" / "p2").mkdir()
    (tmp_path / "in" / "p1" / "a_content_list.json").write_text('﻿[[{"type":"text","text":"一"}],[{"type":"x"}, 3]]', encoding="utf-8")
    (tmp_path / "in" / "p2" / "b_content_list_v2.json").write_text('[{"type":"y"}]', encoding="utf-8")
    (tmp_path / "in" / "p2" / "c_content_list.json").write_text("{broken", encoding="utf-8")
    rows = files.read_layout(spark, str(tmp_path / "in"))
    assert [(r.part, r.prefix, r.error) for r in rows.where("error IS NOT NULL").collect()] == [(3, "p003", "not a list of items")]
    got = rows.where("error IS NULL").orderBy("part", "seq").collect()
    assert [(r.part, r.seq, json.loads(r.item)["type"]) for r in got] == [(1, 0, "text"), (1, 1, "x"), (2, 0, "y")]
    report = str(tmp_path / "r.csv")
    assert files.write_report(spark.createDataFrame([("a", 1), (None, 2)], "name string, n int"), report) == 2
    assert open(report, "rb").read(3) == b"\xef\xbb\xbf" and files.read_csv(spark, report).columns == ["name", "n"]
    books = spark.createDataFrame([("[reviewed].epub",), ("r.epub",), ("a1.epub",), ("a2.epub",)], "book string")
    wanted = spark.createDataFrame([("[reviewed].epub",), ("a*.epub",), ("?1.epub",), ("no",)], "pattern string")
    assert {r.pattern: (r.book, r.matches) for r in files.find_books(wanted, books).collect()} == {"[reviewed].epub": ("[reviewed].epub", 1), "a*.epub": (None, 2), "?1.epub": ("a1.epub", 1), "no": (None, 0)}
    nav = spark.createDataFrame([("b", [0], "A", "f", 1, None), ("b", [0, 1], "C", "f", 3, "c"), ("b", [0, 0], "B", "f", 2, "b"), ("b", [1], "D", "f", None, "d")], "book string, path array<int>, label string, file string, block int, expect string")
    spec = files.book_json(nav)
    assert json.loads(spec.collect()[0].spec)["entries"][0]["children"][1]["label"] == "C"
    back = nodes(spec.select(F.lit(1).alias("id"), "spec"), "id", "spec", "label")
    assert {(r.label, r.parent_path) for r in back.collect()} == {("A", ""), ("B", "entries[0]"), ("C", "entries[0]"), ("D", "")}


def test_later_duplicates_equal_all_pairs(spark):
    rng = random.Random(7)
    rows = [(rng.choice("bc"), i, i, "".join(rng.choices("甲乙丙", k=rng.randint(0, 4)))) for i in range(120)]
    got = {r.entry_id for r in L.later_duplicates(spark.createDataFrame(rows, "book string, entry_id bigint, seq int, label string")).collect()}
    assert got == {i for b, i, _, x in rows for c, j, _, y in rows if b == c and j > i and x and y and (x in y or y in x)}


def test_patterns_equal_the_shell(spark):
    import fnmatch

    rng = random.Random(11)
    names = ["".join(rng.choices("ab.[]", k=rng.randint(1, 5))) for _ in range(60)]
    patterns = ["".join(rng.choices(["a", "b", ".", "*", "?"], k=rng.randint(1, 4))) for _ in range(40)]
    got = {r.pattern: (r.book, r.matches) for r in files.find_books(spark.createDataFrame([(p,) for p in patterns], "pattern string"), spark.createDataFrame([(n,) for n in names], "book string")).collect()}
    for p in set(patterns) - set(names):
        met = sorted({n for n in names if fnmatch.fnmatchcase(n, p)})
        if p.strip("?*"):
            assert got[p] == (met[0] if len(met) == 1 else None, len(met)), p


def test_the_shared_folder_is_asked_for_on_a_cluster():
    import pytest

    from folianth.sources.tables import shared_dir

    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default: default)

        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815
            master = "spark://head:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
