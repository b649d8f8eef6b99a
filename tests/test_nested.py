import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folianth.operators import nested as N


def brute(text, marker, embedded):
    try:
        value = json.loads(text)
    except ValueError:
        return []
    out = []

    def walk(o, path, parent):
        if isinstance(o, dict):
            if marker in o:
                out.append((path, parent))
                parent = path
            for k, v in o.items():
                if k in embedded and isinstance(v, str):
                    try:
                        v = json.loads(v)
                    except ValueError:
                        continue
                walk(v, f"{path}.{k}" if path else k, parent)
        elif isinstance(o, list):
            for i, v in enumerate(o):
                walk(v, f"{path}[{i}]", parent)

    walk(value, "", "")
    return sorted(out)


def found(text, marker="label", embedded=("children",)):
    return sorted((r[1], r[3]) for r in N.record_triples(text, None, marker, frozenset(embedded), frozenset((marker,))))


tree = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.floats(allow_nan=False) | st.text(max_size=4),
    lambda kids: st.lists(kids, max_size=3) | st.dictionaries(st.sampled_from(["label", "children", "a", "b\"", "ü"]), kids, max_size=4), max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(tree, st.booleans(), st.integers(0, 3))
def test_stream_parser_agrees_with_json(value, ascii_only, indent):
    text = json.dumps(value, ensure_ascii=ascii_only, indent=indent or None)
    assert found(text) == brute(text, "label", ("children",))
    nested = json.dumps({"label": 1, "children": text})
    assert found(nested) == brute(nested, "label", ("children",))


@pytest.mark.parametrize("bad", ['{"label":1,}', "[1,]", '{"label" 1}', "{label:1}", "[1 2]", '{"label":1}}', "", "nul", "[01]", '"x', '{"label":[}', "[1.]", '{"label":1 "b":2}', '{"label",1}', "[,1]", '{"label":1', None])
def test_what_cannot_be_parsed_has_no_nodes(bad):
    assert found(bad) == []


def test_depth_and_byte_order_mark():
    deep = '{"label":1,"children":[' * 5000 + "]}" * 5000
    assert len(found(deep)) == 5000
    assert found('﻿{"label":null}') == [("", "")]


def test_tables(spark):
    body = '{"books":[{"entries":[{"label":"a","position":7,"children":[{"label":"b"},null,{"label":null}]},{"label":"c","children":"[{\\"label\\":\\"d\\"}]"}]}]}'
    df = spark.createDataFrame([(1, body, "x"), (1, body, "x"), (2, None, "y"), (3, "", "z"), (4, "{", "z")], "record_id bigint, body string, rec_id string")
    rows = {(r.node_path, r.parent_path, r.label) for r in N.nodes(df, "record_id", "body", "label", embedded=("children",)).collect()}
    e = "books[0].entries"
    assert rows == {(f"{e}[0]", "", "a"), (f"{e}[0].children[0]", f"{e}[0]", "b"), (f"{e}[0].children[2]", f"{e}[0]", None), (f"{e}[1]", "", "c"), (f"{e}[1].children[0]", f"{e}[1]", "d")}
    tables = N.flat_tables(df, "record_id", "body", embedded=("children",))
    assert set(tables) == {"root", "books", "entries", "children"}
    assert {(r.node_path, r.f_position) for r in tables["entries"].select("node_path", "f_position").collect()} == {(f"{e}[0]", "7"), (f"{e}[1]", None)}
    assert N.nodes(df.limit(0), "record_id", "body", "label").count() == 0


def test_content_nodes(spark):
    item = '{"type":"list","content":{"list_items":[{"type":"i","item_content":[{"type":"t"}]},{"x":{"type":"u"}}]}}'
    blocks = spark.createDataFrame([(5, item), (6, '{"type":"text","text":"content"}'), (7, '{"content": [{"type":"a"}]}')], "block_id bigint, item string")
    spec = spark.createDataFrame([], "record_id bigint, body string")
    got = {(r.rec_id, r.node_path, r.parent_path) for r in N.node_links(spec, blocks).collect()}
    i = "content.list_items[0]"
    assert got == {(5, i, ""), (5, f"{i}.item_content[0]", i), (5, "content.list_items[1].x", ""), (7, "content[0]", "")}


def test_array_elements_and_objects_without_the_marker(spark):
    body = '{"books":[{"entries":[{"label":"a","search":["y","x",null,2],"deviation":{"reason":"OCR","by":[{"step":3},{"step":4}]},"grid":[[1,2],[3]]},{"label":null,"search":"s"},{"label":"c","search":[],"children":"[{\\"label\\":\\"d\\",\\"search\\":[\\"z\\"]},\\"loose\\"]"},{"label":"e","search":["old"],"search":["new"]}]}]}'
    df = spark.createDataFrame([(1, body), (1, body)], "record_id bigint, body string")
    found = N.triples(df, "record_id", "body", marker="label", embedded=("children",))
    rows = {r.node_path[17:]: r for r in N.pivot(found, ["label", "search", "deviation.reason", "deviation.by[].step"], ["search", "deviation.by[].step"]).collect()}
    assert {k: (r.label, r.search) for k, r in rows.items()} == {"0]": ("a", ["y", "x", None, "2"]), "1]": (None, ["s"]), "2]": ("c", []), "2].children[0]": ("d", ["z"]), "3]": ("e", ["new"])}
    assert (rows["0]"]["deviation.reason"], rows["0]"]["deviation.by[].step"]) == ("OCR", ["3", "4"])
    values = {(r.node_path[17:], r.key, r.place, r.value) for r in N.elements(found).collect()}
    assert {("0]", "grid", "[0][1]", "2"), ("0]", "grid", "[1][0]", "3"), ("0]", "deviation.by[].step", "[1]", "4"), ("2]", "children", "[1]", "loose"), ("0]", "search", "[2]", None)} < values
    assert len(values) == 4 + 3 + 2 + 1 + 1 + 1
    tables = N.flat_tables(df, "record_id", "body", embedded=("children",))
    assert ["y", "x", None, "2"] in [r.search for r in tables["entries"].select("search").collect()]
    assert [r[4:] for r in N.record_triples("[5,[true]]", elements=True)] == [["value", "5", "number", "[0]"], ["value", "true", "boolean", "[1][0]"]]
