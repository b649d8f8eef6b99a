"""Deeply nested JSON records as flat, related tables.

Each record is stream-parsed: one pass over its tokens with an explicit stack (no recursion, so any depth),
which emits path–value–ordinal triples. Paths are grouped by their repeated ancestor (the path with array
positions left out), and each group is pivoted into one table whose rows keep a link to the parent row.

Defined results:

* a null, empty or unparsable text has no triples; a leading byte-order mark is dropped;
* null elements count in array positions but are no nodes; a scalar or null element is a triple of the object that
  holds the array, under the array's key, with its place (`[2]`, `[0][1]` in arrays of arrays);
* with a marker, the members of an object without it are triples of the nearest node above, under a key that leads to
  them (`deviation.reason`, `by[].step` with its place); members above every node come out only without a marker;
* scalars of an array that is the whole text have the key `value`; a text that is one scalar has no triples;
* a key that an object holds twice keeps its last value (an array's elements and passed-on members too); objects below either value come out;
* a record delivered twice gives the rows of one;
* keys may hold dots or brackets: paths are text for people, the link between tables is the pair of
  record id and path;
* columns of a pivoted table that clash with `rec_id`, `node_path`, `parent_path` or `position` get the prefix `f_`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianth.sources.tables import written

BOM = "﻿"
#: One JSON token with the white space before it; a string key is told by the colon that the parser sees next.
TOKEN = re.compile(
    r'[ \t\n\r]*(?:([{}\[\],:])|"((?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*)"|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w.+-]))|(true|false|null|NaN|-?Infinity)(?!\w))',
    re.ASCII,
)
TRIPLES = "rec_id bigint, ordinal int, owner_path string, group_path string, parent_path string, key string, value string, kind string, place string"
ARROW_TRIPLES = pa.schema([
    ("rec_id", pa.int64()), ("ordinal", pa.int32()), ("owner_path", pa.string()), ("group_path", pa.string()),
    ("parent_path", pa.string()), ("key", pa.string()), ("value", pa.string()), ("kind", pa.string()), ("place", pa.string()),
])


class Malformed(ValueError):
    """The text is no JSON."""


def _text(raw: str) -> str:
    return json.loads(f'"{raw}"') if "\\" in raw else raw


class _Frame:
    """An open object or array."""

    __slots__ = ("is_object", "path", "group", "key", "index", "members", "orphans", "marked", "state", "holder", "holder_key", "place", "listed")

    def __init__(self, is_object: bool, path: str, group: str, holder: _Frame | None = None, holder_key: str = "", place: str = ""):
        self.is_object, self.path, self.group = is_object, path, group
        self.key, self.index = "", -1
        self.members: dict[str, tuple[int, str | None, str]] | None = {} if is_object else None
        self.orphans: list[list] | None = None
        self.marked = False
        self.holder, self.holder_key, self.place = holder, holder_key, place  # the object above, its key and the array positions that lead here
        self.listed: dict[str, list[tuple[int, str, str | None, str, str]]] | None = None  # by key: what arrays and objects without the marker give to this object
        self.state = 0  # object: 0 key or end, 1 colon, 2 value, 3 comma or end, 4 key; array: 2 value, 3 comma or end, 0 value or end

    def give(self, rows: list[tuple[int, str, str | None, str, str]]) -> None:
        """Hand (ordinal, key, value, kind, place) to the object above."""
        if self.holder is not None and rows:
            if self.holder.listed is None:
                self.holder.listed = {}
            self.holder.listed.setdefault(self.holder_key, []).extend(rows)


def kind_of(is_text: bool, literal: str | None) -> str:
    return "string" if is_text else "null" if literal == "null" else "boolean" if literal in ("true", "false") else "number"


def stream(text: str, path: str, group: str, marker: str | None, embedded: frozenset[str], keys: frozenset[str] | None, out: list, ordinal: int = 0, elements: bool = False, above: _Frame | None = None, above_key: str = "") -> tuple[list, int]:
    """Parse one text; append the triples of its objects to `out` as lists in TRIPLES order without the record id.

    `marker`: a node is an object that has this key (any object if None); parents are nodes. `embedded`: keys whose
    string values are read as what they spell. `keys`: emit only members with these names (all if None).
    `elements`: emit scalar elements of arrays too. `above`: the object that gets what the text's top passes on.
    Returns the rows whose enclosing node isn't known yet and the next ordinal. Raises Malformed; `out` may then hold
    rows of the text, which the caller drops.
    """
    pos, end, match = 0, len(text), TOKEN.match
    stack: list[_Frame] = []
    top: _Frame | None = None
    loose: list = []
    done = False
    while True:
        m = match(text, pos)
        if m is None:
            if done and not text[pos:].strip(" \t\n\r"):
                return loose, ordinal
            raise Malformed
        if done:
            raise Malformed
        pos = m.end()
        kind = m.lastindex
        sign = m.group(1)
        if top is not None:
            state = top.state
            if state == 3:
                if sign == ",":
                    top.state = 4 if top.is_object else 2
                    continue
                if sign != ("}" if top.is_object else "]"):
                    raise Malformed
            elif top.is_object:
                if state == 1:
                    if sign != ":":
                        raise Malformed
                    top.state = 2
                    continue
                if state in (0, 4) and not (state == 0 and sign == "}"):
                    if sign or kind is not None and kind > 2 or text[pos - 1] != '"':
                        raise Malformed
                    start = m.start()
                    raw = text[text.index('"', start) + 1 : pos - 1]
                    top.key, top.state = _text(raw), 1
                    continue
        if sign == "{" or sign == "[":
            holder, holder_key, place = above, above_key, ""
            if top is not None:
                holder, holder_key, place = (top, top.key, "") if top.is_object else (top.holder, top.holder_key, f"{top.place}[{top.index + 1}]")
                if top.is_object and top.listed:
                    top.listed.pop(top.key, None)
            if top is None:
                here, generic = path, group
            elif top.is_object:
                here = f"{top.path}.{top.key}" if top.path else top.key
                generic = f"{top.group}.{top.key}" if top.group else top.key
                top.state = 3
            else:
                top.index += 1
                here, generic = f"{top.path}[{top.index}]", top.group + "[]"
                top.state = 3
            if top is not None and top.is_object and (keys is None or top.key in keys):
                top.members[top.key] = (ordinal, None, "object" if sign == "{" else "array")
                ordinal += 1
            if top is not None and top.is_object and top.key == marker:
                top.marked = True
            top = _Frame(sign == "{", here, generic, holder, holder_key, place)
            stack.append(top)
            continue
        if sign == "}" or sign == "]":
            if top is None or top.is_object != (sign == "}") or top.state not in (0, 3):
                raise Malformed
            frame = stack.pop()
            top = stack[-1] if stack else None
            below = frame.orphans or []
            if frame.is_object and (marker is None or frame.marked):
                for row in below:
                    row[3] = frame.path
                below = [[n, frame.path, frame.group, "", k, v, t, None] for k, (n, v, t) in frame.members.items()]
                if frame.listed:
                    below += [[n, frame.path, frame.group, "", *rest] for rows in frame.listed.values() for n, *rest in rows]
                out += below
            elif frame.is_object:
                lead, at = frame.holder_key + "[]" * frame.place.count("["), frame.place
                frame.give([(n, f"{lead}.{k}", v, t, at or None) for k, (n, v, t) in frame.members.items()])
                for rows in (frame.listed or {}).values():
                    frame.give([(n, f"{lead}.{k}", v, t, at + (p or "") or None) for n, k, v, t, p in rows])
            if top is None:
                loose, done = below, True
            elif below:
                if top.orphans is None:
                    top.orphans = below
                else:
                    top.orphans.extend(below)
            continue
        if sign is not None:  # a comma or colon where a value belongs
            raise Malformed
        # a scalar
        literal = m.group(3) or m.group(4)
        if top is None:
            done = True
            continue
        is_text = literal is None
        value: str | None = None
        wanted = keys is None or top.key in keys if top.is_object else elements and top.holder is not None and (keys is None or top.holder_key in keys)
        opens = is_text and top.is_object and top.key in embedded
        if is_text and (wanted or opens):
            value = _text(text[text.index('"', m.start()) + 1 : pos - 1])
        elif wanted and literal != "null":
            value = literal
        if top.is_object:
            top.state = 3
            if top.key == marker:
                top.marked = True
            if top.listed:
                top.listed.pop(top.key, None)
            if wanted:
                top.members[top.key] = (ordinal, value, kind_of(is_text, literal))
                ordinal += 1
            if opens and value and value.lstrip()[:1] in ("{", "["):
                spelled: list = []
                passed = _Frame(True, "", "")
                try:
                    here = f"{top.path}.{top.key}" if top.path else top.key
                    generic = f"{top.group}.{top.key}" if top.group else top.key
                    rows, ordinal = stream(value, here, generic, marker, embedded, keys, spelled, ordinal, elements, passed, top.key)
                    out += spelled
                    if passed.listed:
                        top.listed = (top.listed or {}) | passed.listed
                    if rows:
                        if top.orphans is None:
                            top.orphans = rows
                        else:
                            top.orphans.extend(rows)
                except Malformed:
                    pass
        else:
            top.index += 1
            top.state = 3
            if wanted:
                top.give([(ordinal, top.holder_key, value, kind_of(is_text, literal), f"{top.place}[{top.index}]")])
                ordinal += 1


def record_triples(text: str | None, root: str | None = None, marker: str | None = None, embedded: frozenset[str] = frozenset(), keys: frozenset[str] | None = None, elements: bool = False) -> list[list]:
    """The triples of one record; with `root`, only those at or below this top-level key."""
    if not text:
        return []
    out: list[list] = []
    top = _Frame(True, "", "")
    try:
        stream(text[1:] if text[0] == BOM else text, "", "", marker, embedded, keys, out, 0, elements, top, "value")
    except Malformed:
        return []
    if marker is None and top.listed:
        out += [[n, "", "", "", *rest] for n, *rest in top.listed["value"]]
    if root is not None:
        stops = (root, root + ".", root + "[")
        out = [r for r in out if r[1] == stops[0] or r[1].startswith(stops[1:]) or r[1] == "" and r[7] is None and r[4].startswith(stops[1])]
        for r in out:
            if not (r[3] == stops[0] or r[3].startswith(stops[1:])):
                r[3] = ""  # the enclosing node stands above the root
    return out


def triples(df: DataFrame, id_col: str, text_col: str, root: str | None = None, marker: str | None = None, embedded: tuple[str, ...] = (), keys: tuple[str, ...] | None = None, elements: bool = True) -> DataFrame:
    """Path–value–ordinal triples of every record.

    A triple is one member of an object: the object's path and group (path without positions), the path of the
    nearest enclosing node, the key, the value (null for objects, arrays and null) and its kind; or one scalar element of
    an array that such a member holds, with its place. Objects without members that are asked for give no triple. Narrow: one pass over the table, no shuffle.
    """
    inside, wanted = frozenset(embedded), None if keys is None else frozenset(keys)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(9)]
            for rec, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in record_triples(text, root, marker, inside, wanted, elements):
                    cols[0].append(rec)
                    for c, v in zip(cols[1:], row):
                        c.append(v)
                if len(cols[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ARROW_TRIPLES)], schema=ARROW_TRIPLES)
                    cols = [[] for _ in range(9)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ARROW_TRIPLES)], schema=ARROW_TRIPLES)

    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("rec_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(parse, TRIPLES)


def repeated_ancestor(group_path: Column) -> Column:
    """The group of a path: its last repeated key, so that a tree of any depth makes one table."""
    name = F.regexp_extract(group_path, r"([^.\[\]]*)(?:\[\])+[^\[\]]*$", 1)
    return F.when(name == "", F.lit("root")).otherwise(name)


RESERVED = ("rec_id", "node_path", "parent_path", "position")


def pivot(found: DataFrame, columns: list[str], lists: list[str] = []) -> DataFrame:  # noqa: B006
    """One row for each object, one column for each key; the aggregate also drops second deliveries.

    The keys in `lists` come out as arrays of their elements in order; a scalar there is an array of one.
    """
    named = {c: f"f_{c}" if c.lower() in RESERVED else c for c in columns}

    def column(key: str) -> Column:
        own = F.col("key") == key
        scalar = F.max(F.when(own & F.col("place").isNull(), F.col("value")))
        if key not in lists:
            return scalar
        parts = F.array_sort(F.collect_set(F.when(own & F.col("place").isNotNull(), F.struct("ordinal", "value"))))
        many = F.bool_or(own & (F.col("place").isNotNull() | (F.col("kind") == "array")))
        return F.when(many, F.transform(parts, lambda x: x["value"])).when(scalar.isNotNull(), F.array(scalar))

    return found.groupBy("rec_id", F.col("owner_path").alias("node_path")).agg(F.max("parent_path").alias("parent_path"), F.min("ordinal").alias("position"), *(column(c).alias(n) for c, n in named.items()))


def objects(df: DataFrame, id_col: str, text_col: str, columns: list[str], lists: list[str] = [], root: str | None = None, marker: str | None = None, embedded: tuple[str, ...] = ()) -> DataFrame:  # noqa: B006
    """The rows of `pivot`, made where the records are parsed: what is shuffled is one row for each object, not one for each member."""
    inside = frozenset(embedded)
    named = {c: f"f_{c}" if c.lower() in RESERVED else c for c in columns}
    kinds = {c: "array<string>" if c in lists else "string" for c in columns}
    schema = ", ".join(["rec_id bigint, node_path string, parent_path string, position int", *(f"`{n}` {kinds[c]}" for c, n in named.items())])
    arrow = pa.schema([("rec_id", pa.int64()), ("node_path", pa.string()), ("parent_path", pa.string()), ("position", pa.int32()), *((n, pa.list_(pa.string()) if c in lists else pa.string()) for c, n in named.items())])
    at = {c: k for k, c in enumerate(columns)}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = []
            for rec, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made: dict[str, list] = {}
                for ordinal, owner, _, parent, key, value, kind, place in record_triples(text, root, marker, inside, None, True):
                    row = made.setdefault(owner, [rec, owner, parent, ordinal, *([None] * len(columns))])
                    row[3] = min(row[3], ordinal)
                    if key not in at:
                        continue
                    k = 4 + at[key]
                    if key in lists:
                        if place is not None or kind == "array":
                            row[k] = [*(row[k] or []), (ordinal, value)] if place is not None else row[k] or []
                        elif value is not None and row[k] is None:
                            row[k] = [(ordinal, value)]
                    elif place is None and value is not None:
                        row[k] = value
                for row in made.values():
                    for key in lists:
                        k = 4 + at[key]
                        row[k] = None if row[k] is None else [v for _, v in sorted(row[k], key=lambda x: x[0])]
                    out.append(row)
            cols = list(zip(*out)) if out else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("rec_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(parse, schema)
    return rows.groupBy("rec_id", "node_path").agg(*(F.max(f"`{c}`").alias(c) for c in rows.columns if c not in ("rec_id", "node_path")))


def elements(found: DataFrame) -> DataFrame:
    """(rec_id, node_path, key, place, position, value, kind): a row for each value that stands in an array, linked to its object."""
    return found.where(F.col("place").isNotNull()).select("rec_id", F.col("owner_path").alias("node_path"), "key", "place", F.col("ordinal").alias("position"), "value", "kind").distinct()


def grouped(found: DataFrame) -> DataFrame:
    """(table, rec_id, node_path, parent_path, position, fields): every object under the table of its repeated ancestor, its values by key.

    The tables of all groups in one: `fields` has the columns that an object of the group holds (objects and arrays below it are tables of
    their own, linked by `parent_path`; arrays of values are joined as JSON text).
    """
    one = found.withColumn("table", repeated_ancestor(F.col("group_path"))).groupBy("table", "rec_id", F.col("owner_path").alias("node_path"), "key").agg(
        F.max("parent_path").alias("parent_path"), F.min("ordinal").alias("position"), F.max(F.when(F.col("place").isNull(), F.col("value"))).alias("value"),
        F.array_sort(F.collect_set(F.when(F.col("place").isNotNull(), F.struct("ordinal", "value")))).alias("many"),
    )
    value = F.when(F.size("many") > 0, F.to_json(F.transform("many", lambda x: x["value"]))).otherwise(F.col("value"))
    pair = F.when(value.isNotNull(), F.struct("key", value.alias("value")))
    return one.groupBy("table", "rec_id", "node_path").agg(F.max("parent_path").alias("parent_path"), F.min("position").alias("position"), F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("fields"))


def flat_tables(df: DataFrame, id_col: str, text_col: str, root: str | None = None, marker: str | None = None, embedded: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """One table for each group of paths with the same repeated ancestor.

    The records are parsed once: the triples are written and every table reads its own. The groups and their keys are the only thing
    gathered on the driver: names of the schema, not data.
    """
    found = written(triples(df, id_col, text_col, root, marker, embedded).withColumn("table", repeated_ancestor(F.col("group_path"))), "triples", ["table"])
    names: dict[str, dict[str, bool]] = {}
    for r in found.groupBy("table", "key").agg(F.bool_or(F.col("place").isNotNull() & (F.col("kind") != "null")).alias("many")).orderBy("table", "key").toLocalIterator():
        names.setdefault(r["table"], {})[r["key"]] = r["many"]
    return {t: pivot(found.where(F.col("table") == t), list(keys), [k for k, many in keys.items() if many]) for t, keys in names.items()}


def nodes(df: DataFrame, id_col: str, text_col: str, marker: str, root: str | None = None, embedded: tuple[str, ...] = ()) -> DataFrame:
    """(rec_id, node_path, parent_path, position, <marker>) of every object that has the key `marker`."""
    return pivot(triples(df, id_col, text_col, root, marker, embedded, keys=(marker,), elements=False), [marker])


def node_links(spec_records: DataFrame, content_blocks: DataFrame) -> DataFrame:
    """The nodes of review specs and of layout items: (src, rec_id, node_path, parent_path)."""
    out = ("rec_id", "node_path", "parent_path")
    spec = nodes(spec_records, "record_id", "body", "label", embedded=("children",)).select(F.lit("spec").alias("src"), *out)
    held = content_blocks.where(F.col("item").contains('"content"') | F.col("item").contains("\\u"))
    content = nodes(held, "block_id", "item", "type", root="content").select(F.lit("content").alias("src"), *out)
    return spec.unionByName(content)
