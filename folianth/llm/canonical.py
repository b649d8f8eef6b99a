"""Problem 1: one consistent form for text that looks the same.

Arrow text is copied into numpy code-point arrays; a lookup table over all code points says what each
becomes (nothing, one or several code points), expansion offsets place the results, and combining marks
are ordered and composed by vectorised passes. No string function is called per row.

The form is a comparison form:

* full-width, half-width, radical and compatibility forms become the ordinary character;
* every kind of single space becomes U+0020 (runs are kept: a space differs from no space);
* code points that take no room (joiners, marks of direction, soft hyphens, variation selectors) go;
* hyphens of one look become `-`, middle dots `·`;
* letters and signs of another script with the same shape become Latin letters or ideographs;
* decomposed accents are composed.

Letter case, raised or lowered figures, fractions and circled numbers stay different.
Null gives null, the empty text the empty text; no length is limited.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folianth.llm.codepoints import from_codepoints, null_mask, to_codepoints

# Letters of other scripts with the shape of a Latin letter.
SAME_SHAPE = {
    "A": "АΑᎪꓮ", "B": "ВΒᏴꓐⲂ", "C": "СϹᏟꓚⲤ", "D": "Ꭰꓓ", "E": "ЕΕᎬꓰ", "F": "ꓝϜ", "G": "Ꮐꓖ", "H": "НΗᎻꓧⲎ", "I": "ІΙӀꓲⲒ", "J": "ЈᎫꓙ", "K": "КΚᏦꓗⲔ",
    "L": "Ꮮꓡ", "M": "МΜᎷꓟⲘ", "N": "ΝꓠⲚ", "O": "ОΟՕꓳⲞ", "P": "РΡᏢꓑⲢ", "Q": "Ԛ", "R": "Ꮢꓣ", "S": "ЅᏚՏꓢ", "T": "ТΤᎢꓔⲦ", "U": "Սꓴ", "V": "ѴᏙꓦ", "W": "ԜᎳꓪ",
    "X": "ХΧꓫⲬ", "Y": "ҮΥꓬⲨ", "Z": "ΖᏃꓜ", "a": "аɑ", "c": "сϲꮯⲥ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "і", "j": "јϳ",
    "l": "ӏ", "n": "ո", "o": "оοօⲟ", "p": "рρⲣ", "q": "ԛզ", "s": "ѕꮪ", "u": "սυ", "v": "ѵνꮩ", "w": "ԝꮃ", "x": "х", "y": "уү", "z": "ꮓ",
    # hyphens of one look, middle dots of one look, signs doubled in other blocks
    "-": "‐‑﹣－˗", "·": "··‧⋅・･", "'": "′＇", ":": "：︰ː∶", "/": "／∕⁄", "|": "｜∣ǀ", "!": "！ǃ", "*": "＊∗", "~": "～∼", ";": ";；", ",": "，",
}
# Kana with the shape of an ideograph or of the other kana; folded after composition, as a voicing mark makes another kana.
SAME_SHAPE_KANA = {"二": "ニ", "力": "カ", "口": "ロ", "八": "ハ", "工": "エ", "夕": "タ", "卜": "ト", "へ": "ヘ", "べ": "ベ", "ぺ": "ペ", "一": "ー〡"}
#: Compatibility classes of the Unicode data that keep the shape; raised, lowered, circled forms and fractions are left out.
KEPT_SHAPE = {"<wide>", "<narrow>", "<compat>", "<noBreak>", "<font>", "<isolated>", "<initial>", "<medial>", "<final>"}
#: Ranges of code points that take no room.
NO_ROOM = [
    (0x00, 0x08), (0x0E, 0x1F), (0x7F, 0x84), (0x86, 0x9F), (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x17B4, 0x17B5), (0x180B, 0x180F),
    (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFB), (0xE0000, 0xE0FFF),
]
LIMIT = 0x110000
DATA_END = 0x30000  # no decompositions beyond
HANGUL = (0xAC00, 0x1100, 0x1161, 0x11A7, 19, 21, 28)


def _expand(c: int) -> list[int]:
    """Full decomposition of one code point within the kept classes."""
    parts = unicodedata.decomposition(chr(c)).split()
    if not parts:
        return [c]
    if parts[0][0] == "<":
        if parts[0] not in KEPT_SHAPE:
            return [c]
        parts = parts[1:]
    codes = [int(p, 16) for p in parts]
    if len(codes) > 1 and codes[0] == 0x20:  # a spacing accent is a sign of its own
        return [c]
    return [x for p in codes for x in _expand(p)]


@lru_cache(maxsize=1)
def tables() -> dict[str, np.ndarray]:
    """Lookup tables, built once per process from the Unicode data of the running Python."""
    fold = {ord(x): ord(k) for k, v in SAME_SHAPE.items() for x in v if x != k}
    lengths, offsets, pool = np.ones(LIMIT, np.uint8), np.full(LIMIT, -1, np.int32), []
    pairs: dict[int, int] = {}
    ccc = np.zeros(LIMIT, np.uint8)
    for c in range(DATA_END):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if 0xA0 <= c and (k := unicodedata.combining(ch)):
            ccc[c] = k
        out = _expand(c) if c >= 0xA0 else [c]
        out = [fold.get(x, x) for x in out]
        if c in fold:
            out = [fold[c]]
        out = [0x20 if x in (9, 10, 11, 12, 13, 0x85, 0x2028, 0x2029) or x > 0x7F and unicodedata.category(chr(x)) == "Zs" else x for x in out]
        if out != [c]:
            lengths[c], offsets[c] = len(out), len(pool)
            pool += out
        d = unicodedata.decomposition(ch).split()
        if len(d) == 2 and d[0][0] != "<" and unicodedata.normalize("NFC", unicodedata.normalize("NFD", ch)) == ch:
            pairs[int(d[0], 16) << 21 | int(d[1], 16)] = c
    for lo, hi in NO_ROOM:
        lengths[lo : hi + 1], offsets[lo : hi + 1] = 0, 0
    keys = np.array(sorted(pairs), np.int64)
    kana = np.arange(0x3200, dtype=np.uint32)
    for k, v in SAME_SHAPE_KANA.items():
        for x in v:
            kana[ord(x)] = ord(k)
    return {
        "lengths": lengths, "offsets": offsets, "pool": np.array(pool, np.uint32), "ccc": ccc,
        "pair": keys, "composed": np.array([pairs[k] for k in keys.tolist()], np.uint32), "kana": kana,
    }


def _gather(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each code point by its expansion."""
    t = tables()
    size, at = t["lengths"][codes], t["offsets"][codes]
    if (at < 0).all():
        return codes, offsets
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    out = np.repeat(codes, size)
    place = np.repeat(at, size)
    step = np.arange(len(out)) - np.repeat(ends[:-1], size)
    hit = place >= 0
    out[hit] = t["pool"][place[hit] + step[hit]]
    return out, ends[offsets]


def _compose(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order combining marks and compose them with their base; also conjoining Hangul letters."""
    t = tables()
    if not len(codes) or codes.max(initial=0) < 0x300:
        return codes, offsets
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    base_h, l0, v0, t0, ln, vn, tn = HANGUL
    rank = t["ccc"][codes]
    if not rank.any() and not ((codes >= v0) & (codes < 0x1200)).any():
        return codes, offsets
    where = np.arange(len(codes))
    starter = np.maximum.accumulate(np.where(rank == 0, where, -1))
    marks = rank > 0
    if (marks[1:] & marks[:-1]).any():  # canonical order inside each run of marks
        run = np.where(marks, np.cumsum(~marks), -1)
        m = np.flatnonzero(marks)
        order = np.lexsort((m, rank[m], run[m], row[m]))
        codes = codes.copy()
        codes[m] = codes[m][order]
        rank = t["ccc"][codes]
    while True:
        where = np.arange(len(codes))
        starter = np.maximum.accumulate(np.where(rank == 0, where, -1))
        first = offsets[:-1][row]
        prev = np.concatenate([[-1], where[:-1]])
        before = np.concatenate([[0], rank[:-1]])
        base_of = np.where(rank > 0, starter, np.where(prev >= first, prev, -1))
        free = np.where(rank > 0, (prev == base_of) | (before < rank), before == 0)
        j = np.flatnonzero((base_of >= first) & free & (base_of < where))
        a, b = codes[base_of[j]].astype(np.int64), codes[j].astype(np.int64)
        key = (a << 21) | b
        pos = np.minimum(np.searchsorted(t["pair"], key), len(t["pair"]) - 1)
        to = np.where(t["pair"][pos] == key, t["composed"][pos], 0).astype(np.int64)
        lv = (a >= l0) & (a < l0 + ln) & (b >= v0) & (b < v0 + vn)
        to[lv] = base_h + ((a[lv] - l0) * vn + (b[lv] - v0)) * tn
        lvt = (a >= base_h) & (a < base_h + ln * vn * tn) & ((a - base_h) % tn == 0) & (b > t0) & (b < t0 + tn)
        to[lvt] = a[lvt] + b[lvt] - t0
        j, to = j[to > 0], to[to > 0]
        if not len(j):
            return codes, offsets
        targets, at = np.unique(base_of[j], return_index=True)
        j, to = j[at], to[at]
        clash = np.isin(targets, j)  # a base that is itself consumed in this pass waits for the next
        targets, j, to = targets[~clash], j[~clash], to[~clash]
        if not len(j):
            return codes, offsets
        codes = codes.copy()
        codes[targets] = to
        keep = np.ones(len(codes), bool)
        keep[j] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        codes, row, rank, offsets = codes[keep], row[keep], rank[keep], kept[offsets]


def _kana(codes: np.ndarray) -> np.ndarray:
    """Kana that look like an ideograph or like the other kana."""
    hit = (codes >= 0x3020) & (codes < 0x3100)
    if not hit.any():
        return codes
    codes = codes.copy()
    codes[hit] = tables()["kana"][codes[hit]]
    return codes


def canonical_array(arr: pa.Array) -> pa.Array:
    """The canonical form of a string array or of an array of string lists."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_list(arr.type):
        arr = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(np.nan_to_num(arr.value_lengths().to_numpy(zero_copy_only=False)))]).astype(np.int32)),
            canonical_array(arr.flatten()),
            mask=arr.is_null() if arr.null_count else None,
        )
        return arr
    nulls = null_mask(arr)
    codes, offsets = to_codepoints(arr)
    codes, offsets = _compose(*_gather(codes, offsets))
    return from_codepoints(_kana(codes), offsets, nulls)


@lru_cache(maxsize=1)
def _udfs():
    from pyspark.sql.functions import arrow_udf

    def one(a: pa.Array) -> pa.Array:
        return canonical_array(a)

    return arrow_udf(one, "string"), arrow_udf(one, "array<string>")


def canonical(col: Column | str) -> Column:
    """The canonical form of a string column."""
    return _udfs()[0](F.col(col) if isinstance(col, str) else col)


def canonical_list(col: Column | str) -> Column:
    """The canonical form of each text of an array<string> column."""
    return _udfs()[1](F.col(col) if isinstance(col, str) else col)


def canonicalize(df: DataFrame, columns: list[str], suffix: str = "_canon") -> DataFrame:
    """Add the canonical form of string or array<string> columns.

    Rows, order of columns and all other columns stay; a column `<name><suffix>` that exists is replaced.
    Null texts give null; repeated rows give repeated rows; an empty table gives an empty table.
    """
    kinds = dict(df.dtypes)
    return df.withColumns({c + suffix: canonical_list(F.col(f"`{c}`")) if kinds[c].startswith("array") else canonical(F.col(f"`{c}`")) for c in columns})


def same_look(entries: DataFrame) -> DataFrame:
    """(entry_id, field): `expect`, or a text of `search`, differs from `label` in characters but not in look.

    A row delivered twice counts once; null labels and null texts give no row.
    """
    df = canonicalize(entries.select("entry_id", "label", "expect", "search"), ["label", "expect", "search"], "_c")
    hit = F.array_compact(
        F.array(
            F.when((F.col("expect") != F.col("label")) & (F.col("expect_c") == F.col("label_c")), F.lit("expect")),
            F.when(F.exists(F.arrays_zip(F.col("search").alias("a"), F.col("search_c").alias("b")), lambda x: (x["a"] != F.col("label")) & (x["b"] == F.col("label_c"))), F.lit("search")),
        )
    )
    return df.select("entry_id", F.explode(hit).alias("field")).distinct()
