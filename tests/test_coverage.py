import random

import pytest

from folianth.operators import coverage as C

LINES = ["第三章 涨潮", "第五章 退潮", "第六章 平潮", "附表 潮位", "谢词"]


def run(spark, lines, entries, dropped=()):
    printed = spark.createDataFrame([("b", i, f"{x}……{i * 9}") for i, x in enumerate(lines, 1)], "book string, line_no int, line string")
    e = spark.createDataFrame([("b", *x) for x in entries], "book string, label string, deviation string, printed string")
    d = spark.createDataFrame([("b", x) for x in dropped], "book string, line string")
    toc, keys = C.printed_titles(printed), C.label_keys(e)
    v = C.accounted(toc, keys, d)
    return C.by_book(v), C.additions(toc, keys), v


SPEC = [("第三章 涨潮", None, None), ("第五章 退潮", None, None), ("第六章 平潮", None, None), ("尾声", "added", None)]


@pytest.mark.parametrize("dropped, want, code", [(["附表 潮位", "谢词"], (3, 2, 0), 0), (["附表 潮位"], (3, 1, 1), 3)])
def test_gate(spark, dropped, want, code):
    books, added, _ = run(spark, LINES, SPEC, dropped)
    r = books.collect()[0]
    assert (r.restored, r.explained, r.silent) == want and added.count() == 0
    assert C.gate(books, added) == code and C.gate(books.limit(0), added) == 2


def test_additions_renames_and_wrapped_titles(spark):
    books, added, _ = run(spark, LINES, [*SPEC[:3], ("尾声", None, None)], LINES[3:])
    assert [r.key for r in added.collect()] == ["尾声"] and C.gate(books, added) == 0 and C.gate(books, added, strict=True) == 4
    damaged = [*LINES[:2], "第六章 平朝", *LINES[3:]]
    assert run(spark, damaged, [*SPEC[:2], ("第六章 平潮", None, "第六章 平朝")], LINES[3:])[0].collect()[0].silent == 0
    assert run(spark, damaged, SPEC[:3], LINES[3:])[0].collect()[0].silent == 1
    wrapped = run(spark, ["漫长的海岸", "线完整画出了", "甲乙", "丙丁", "戊己"], [("漫长的海岸线完整画出了", None, None)])[0].collect()[0]
    assert (wrapped.restored, wrapped.silent) == (2, 3)


def test_accounting_equals_the_greedy_fold(spark):
    rng = random.Random(1)
    lines = [rng.choice(["aa", "bb", "qq"]) for _ in range(120)]
    known = {"aabb", "bbqq", "qqaa", "qq", "aaaa"}
    got = {r.line_no: r.verdict for r in run(spark, lines, [(k, None, None) for k in known])[2].collect()}
    want, i = {}, 0
    while i < len(lines):
        pair = lines[i] + (lines[i + 1] if i + 1 < len(lines) else "")
        step = 1 if lines[i] in known else 2 if i + 1 < len(lines) and pair in known else 0
        for k in range(max(1, step)):
            want[i + 1 + k] = "restored" if step else "silent"
        i += max(1, step)
    assert got == want
