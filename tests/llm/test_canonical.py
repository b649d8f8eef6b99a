import unicodedata

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folianth.llm import canonical as C

chars = st.text(st.sampled_from([*"abeoAO .-", *map(chr, range(0xC0, 0x180)), "́", "̈", "̧", "̣", "ᄀ", "ᅡ", "ᆨ", "한", "Ａ", "　", "​", "章", "⼀", "\U0001f600"]), max_size=12)


def one(text):
    return C.canonical_array(pa.array([text])).to_pylist()[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(chars | st.none(), max_size=8))
def test_form_is_composed_stable_and_row_by_row(texts):
    out = C.canonical_array(pa.array(texts, pa.string())).to_pylist()
    assert [t is None for t in texts] == [o is None for o in out]
    assert out == [None if t is None else one(t) for t in texts]
    assert C.canonical_array(pa.array(out, pa.string())).to_pylist() == out
    for t, o in zip(texts, out):
        if t is not None:
            assert unicodedata.normalize("NFC", o) == o
            assert one(unicodedata.normalize("NFD", t)) == o == one(unicodedata.normalize("NFC", t))


def test_same_and_different():
    same = [("Ａｂｃ，１", "Abc,1"), ("The Quiet", "Тhе Quiеt"), ("a b", "a\u00a0b"), ("a b", "a　b"), ("naïve", "nai\u0308ve"), ("章節", "章​節\xad"), ("well-being", "well‐being"), ("一力口", "⼀カロ"), ("·", "・"), ("ﾊﾟ", "パ")]
    for a, b in same:
        assert one(a) == one(b), (a, b)
    for a, b in [("a b", "ab"), ("A", "a"), ("x2", "x²"), ("人", "入"), ("a  b", "a b"), ("未", "末"), ("バ", "ハ")]:
        assert one(a) != one(b), (a, b)
    assert one("x" * 300_000 + "Ａ") == "x" * 300_000 + "A" and one("") == ""
    assert C.canonical_array(pa.array([["Ａ", None, ""], None, []])).to_pylist() == [["A", None, ""], None, []]


def test_queries(spark):
    rows = [(1, "ab", "ａb", ["ab"], "x"), (1, "ab", "ａb", ["ab"], "x"), (2, "a", "a", ["а", None], "y"), (3, None, "a", None, None), (4, "a", None, [], None), (5, "a", "b", ["a", "c"], None)]
    df = spark.createDataFrame(rows, "entry_id bigint, label string, expect string, search array<string>, label_canon string")
    assert sorted(map(tuple, C.same_look(df).collect())) == [(1, "expect"), (2, "search")]
    assert C.same_look(df.limit(0)).count() == 0
    got = C.canonicalize(df, ["label"])
    assert got.columns == df.columns and got.where("entry_id = 1").count() == 2
