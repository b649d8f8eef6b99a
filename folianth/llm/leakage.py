"""Problem 6: evaluation passages inside a training corpus.

The items' normalised n-grams are a broadcast hash set. Every document is normalised vectorially (lower case, width,
look-alikes and accents folded; everything but letters, digits and ideographs dropped, so line breaks, spacing,
punctuation and quoting don't matter) and all its windows are hashed by one prefix sum and looked up. Hits are verified: the
characters of both windows are compared, hits of one document and item are merged into pieces along a diagonal (a changed word only
interrupts a piece), and the pieces that follow the item's order are chained. A document leaks an item if a chain holds at
least `share` of the item, however many pieces it is made of; a piece is one window or more. What such a chain takes is set aside
and the rest is chained again, so every copy of an item gives its spans, and all of them are removed.

Stock phrases make chance pieces: a pass before counts, for each gram, the documents that hold it with less than CHANCE
of its item. A piece whose grams all stand in at least STOCK such documents, and in STOCK_SHARE of all, counts for nothing.

The broadcast is bounded by `max_grams`. More grams than that are never broadcast: a bit map of their hashes sieves the windows in
the scan, and the few windows that pass meet the grams in a join on the characters themselves. Both ways give the same rows.
Null or empty texts leak nothing; an item without letters is never found; an item under two windows long uses a
window of half its length; equal items are reported each; texts are scanned whole, of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folianth.llm.canonical import tables
from folianth.llm.codepoints import from_codepoints, to_codepoints
from folianth.sources.tables import written

#: Window in characters for texts of ideographs and for texts of letters.
WINDOW_CJK, WINDOW_LATIN = 6, 16
#: The share of an item that makes a leak (two fifths), less what a changed word hides at the two ends of a piece.
SHARE, EDGE = 0.4, 0.03
#: So much of a piece is windows of the item; the rest is changed words.
DENSE = 0.4
#: A document with less than this share of an item is no case, so what it has of the item is there by chance.
CHANCE = 0.2
#: A gram is a stock phrase if so many documents, and this share of all, hold it by chance.
STOCK, STOCK_SHARE = 3, 1e-3
MAX_GRAMS = 4_000_000
CHUNK = 300_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """For every code point the one character it is compared as, or 0 if it doesn't count."""
    import unicodedata

    t = tables()
    out = np.zeros(0x110000, np.uint32)
    first = np.arange(0x110000, dtype=np.int64)
    hit = (t["offsets"] >= 0) & (t["lengths"] > 0)
    first[hit] = t["pool"][t["offsets"][hit]]
    first[t["lengths"] == 0] = 0
    first[: len(t["kana"])] = np.where(first[: len(t["kana"])] < len(t["kana"]), t["kana"][np.minimum(first[: len(t["kana"])], len(t["kana"]) - 1)], first[: len(t["kana"])])
    for c in range(0x30000):
        f = int(first[c])
        if not f or 0xD800 <= f < 0xE000:
            continue
        ch = chr(f).lower()[:1]
        if ch and unicodedata.category(ch)[0] in "LN":
            out[c] = ord(ch)
    out[0x30000:0x323B0] = np.arange(0x30000, 0x323B0)
    return out


def normalised(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters that count, row offsets, their places in the original text's code points)."""
    out = folded()[codes]
    keep = out > 0
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[offsets], np.flatnonzero(keep)


def window_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n characters; windows that cross rows are the caller's to drop."""
    if len(chars) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(chars) - 1, BASE)]))
        mixed = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * power)])
        inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(chars) - n, BASE_INV)]))
        h = (prefix[n:] - prefix[:-n]) * inverse
        return h ^ (h >> np.uint64(31))


class Items:
    """The n-grams of a block of items, sorted by hash, with item and place."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids, self.sizes, self.windows = [], [], []
        texts: list[np.ndarray] = []
        per: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item_id, text in rows:
            codes, offsets = to_codepoints(pa.array([text or ""]))
            chars, _, _ = normalised(codes, offsets)
            if not len(chars):
                continue
            n = WINDOW_CJK if (chars >= 0x2E80).mean() > 0.3 else WINDOW_LATIN
            n = n if len(chars) >= 2 * n else max(1, len(chars) // 2)
            per.setdefault(n, []).append((window_hashes(chars, n), len(self.ids)))
            self.ids.append(item_id)
            self.sizes.append(len(chars))
            self.windows.append(n)
            texts.append(chars)
        self.chars = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, parts in per.items():
            h = np.concatenate([p[0] for p in parts])
            who = np.concatenate([np.full(len(p[0]), p[1], np.int32) for p in parts])
            at = np.concatenate([np.arange(len(p[0]), dtype=np.int32) for p in parts])
            order = np.argsort(h, kind="stable")
            self.grams[n] = h[order], who[order], at[order]
        self.rare: dict[int, np.ndarray] = {n: np.ones(len(g[0]), bool) for n, g in self.grams.items()}
        self._sieves: dict[int, np.ndarray] = {}

    def sieve(self, n: int) -> np.ndarray:
        """One flag for each value of a hash's low bits: most windows are no gram and end here. Built where it is used."""
        if n not in self._sieves:
            grams = self.grams[n][0]
            bits = min(26, max(16, len(grams).bit_length() + 5))
            flags = np.zeros(1 << bits, bool)
            flags[grams & np.uint64((1 << bits) - 1)] = True
            self._sieves[n] = flags
        return self._sieves[n]


def pieces(i: np.ndarray, j: np.ndarray, n: int, rare: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """Hits (item place, document place), by document place, merged into pieces (i from, i to, j from, j to).

    A piece without any `rare` hit is made of stock phrases only and left out.
    """
    gap, shift = (12, 5) if n <= WINDOW_CJK else (60, 18)
    open_: list[list[int]] = []
    near: dict[int, set[int]] = {}  # open pieces by their last diagonal: a hit is at most `shift` away from its piece
    for a, b, r in zip(i.tolist(), j.tolist(), [True] * len(i) if rare is None else rare.tolist()):
        lane, best = (a - b) // (shift + 1), -1
        for x in (lane - 1, lane, lane + 1):
            over = []
            for k in near.get(x, ()):
                p = open_[k]
                if b - p[3] > gap + n:
                    over.append(k)  # hits come by document place: no later one can reach it
                elif k > best and 0 <= a - p[1] <= gap + n and a > p[0] and b >= p[3] and abs((a - p[1]) - (b - p[3])) <= shift:
                    best = k
            if over:
                near[x].difference_update(over)
        if best < 0:
            best = len(open_)
            open_.append([a, a, b, b, n, r])
        else:
            p = open_[best]
            near[(p[1] - p[3]) // (shift + 1)].discard(best)
            p[4] += min(n, a - p[1])
            p[1], p[3], p[5] = a, b, p[5] or r
        near.setdefault(lane, set()).add(best)
    return [(p[0], p[1] + n, p[2], p[3] + n) for p in open_ if p[5] and p[4] >= DENSE * (p[1] + n - p[0])]


def chain(found: list[tuple[int, int, int, int]]) -> tuple[int, list[tuple[int, int, int, int]]]:
    """The in-order pieces that hold most of the item, and how many of its characters they hold."""
    found = sorted(found, key=lambda p: (p[3], p[1]))
    if not found:
        return 0, []
    i0, i1, j0, j1 = np.array(found, np.int64).T
    reach = j1 - (j1 - j0) // 2
    held, before = i1 - i0, np.full(len(found), -1)
    for k in range(1, len(found)):
        gain = np.where((i1[:k] < i1[k]) & (reach[:k] <= j0[k]) & (j0[:k] < j0[k]), held[:k] + i1[k] - np.maximum(i0[k], i1[:k]), -1)
        m = int(gain.argmax())
        if gain[m] > held[k]:
            held[k], before[k] = gain[m], m
    k = int(held.argmax())
    total, out = int(held[k]), []
    while k >= 0:
        out.append(found[k])
        k = int(before[k])
    return total, out[::-1]


def hits(texts: pa.Array, items: Items) -> tuple[np.ndarray, ...] | None:
    """(row, item, item place, document place, n of the gram, its index) of all hits, by row, item and document place; then the text's arrays."""
    codes, offsets = to_codepoints(texts)
    chars, rows, places = normalised(codes, offsets)
    if not len(chars):
        return None
    found: list[np.ndarray] = []
    for n, (grams, who, at) in items.grams.items():
        h = window_hashes(chars, n)
        flags = items.sieve(n)
        ok = np.flatnonzero(flags[h & np.uint64(len(flags) - 1)])
        ok = ok[grams[np.minimum(np.searchsorted(grams, h[ok]), len(grams) - 1)] == h[ok]]
        if not len(ok):
            continue
        row = np.searchsorted(rows, ok, side="right") - 1
        inside = ok + n <= rows[row + 1]
        ok, row = ok[inside], row[inside]
        lo = np.searchsorted(grams, h[ok])
        count = np.searchsorted(grams, h[ok], side="right") - lo
        every = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found.append(np.stack([np.repeat(row, count), who[every], at[every], np.repeat(ok, count), np.full(len(every), n), every]))
    if not found:
        return None
    all_ = np.concatenate(found, axis=1)
    return *all_[:, np.lexsort((all_[3], all_[1], all_[0]))], offsets, places, chars


def compared(items: Items, chars: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which hits hold character by character: one hash may stand for two windows."""
    same = np.ones(len(i), bool)
    start = items.begins[item] + i
    for k in range(int(n.max(initial=0))):
        inside = k < n
        same[inside] &= items.chars[start[inside] + k] == chars[j[inside] + k]
    return same


def pairs(row: np.ndarray, item: np.ndarray, items: Items) -> np.ndarray:
    """Where each pair of row and item begins, and the end."""
    pair = row.astype(np.int64) * len(items.ids) + item
    return np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1], [True]]))


def chance(texts: pa.Array, items: Items, counts: dict[int, np.ndarray]) -> None:
    """Add to `counts` how many texts hold each gram of an item of which they hold less than CHANCE."""
    got = hits(texts, items)
    if got is None:
        return
    row, item, _, _, n, gram, _, _, _ = got
    at = pairs(row, item, items)
    few = np.diff(at) < CHANCE * (np.array(items.sizes) - np.array(items.windows) + 1)[item[at[:-1]]]
    keep = np.repeat(few, np.diff(at))
    for w, into in counts.items():
        own = keep & (n == w)
        into += np.bincount(np.unique(row[own] * len(into) + gram[own]) % len(into), minlength=len(into))


def copies(i: np.ndarray, j: np.ndarray, n: int, size: int, rare: np.ndarray, share: float) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """(characters held, pieces) of every chain that holds the share of an item, the fullest first; no two of them overlap in the text."""
    # a hit covers one window, and pieces that cover each other's places can be thinned to two at a place: fewer can't make the share
    least = DENSE * (share - EDGE) * size / n
    if len(i) < least or len(np.unique(i)) < least / 2 or not rare.any():
        return []
    left, out = pieces(i, j, n, rare), []
    while left:
        held, chained = chain(left)
        if held < (share - EDGE) * size:
            break
        out.append((held, chained))
        taken = set(chained)
        left = [p for p in left if p not in taken and not any(p[2] < q[3] and q[2] < p[3] for q in chained)]
    return out


def scan(texts: pa.Array, items: Items, share: float = SHARE) -> Iterator[tuple[int, int, float, list[tuple[int, int]]]]:
    """(row, item, share held, spans in the row's code points) of every copy of an item in a block of texts."""
    got = hits(texts, items)
    if got is None:
        return
    row, item, i, j, n, gram, offsets, places, chars = got
    rare = np.zeros(len(gram), bool)
    for w, flags in items.rare.items():
        rare[n == w] = flags[gram[n == w]]
    starts = pairs(row, item, items)
    size = np.array(items.sizes)[item[starts[:-1]]]
    # so much of an item its hits cover at most; a piece is covered to DENSE, so what covers less can't make the share
    pair = np.repeat(np.arange(len(size)), np.diff(starts))
    order = np.lexsort((i, pair))
    step = np.diff(i[order], append=0)
    step[starts[1:] - 1] = 1 << 40
    covered = np.bincount(pair, np.minimum(step, n[order]))
    likely = (covered >= DENSE * (share - EDGE) * size) & (np.bincount(pair, rare) > 0)
    keep = likely[pair]
    keep[keep] = compared(items, chars, item[keep], i[keep], j[keep], n[keep])
    row, item, i, j, rare = row[keep], item[keep], i[keep], j[keep], rare[keep]
    if not len(row):
        return
    starts = pairs(row, item, items)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        k, r = int(item[a]), int(row[a])
        for held, chained in copies(i[a:b], j[a:b], items.windows[k], items.sizes[k], rare[a:b], share):
            yield r, items.ids[k], min(1.0, held / items.sizes[k]), [(int(places[p[2]] - offsets[r]), int(places[p[3] - 1] - offsets[r]) + 1) for p in chained]


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about `limit` bytes, whole texts each."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
    at = 0
    while at < len(texts):
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


def _asked(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items.where(F.length(F.col(f"`{text_col}`")) > 0).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).distinct()


def block_of(asked: DataFrame, max_grams: int) -> Items | None:
    """The items as one block, or None if they may have more than `max_grams` n-grams (an item has no more windows than characters)."""
    if (asked.agg(F.sum(F.length("text")).alias("n")).collect()[0]["n"] or 0) > max_grams:
        return None
    return Items([(r["id"], r["text"]) for r in asked.orderBy("id", "text").toLocalIterator()])


def without_stock(docs: DataFrame, block: Items) -> None:
    """Mark the grams of a block that are stock phrases of the corpus: one pass, which returns a number for each gram of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = shared.value, 0
        counts = {w: np.zeros(len(g[0]), np.int64) for w, g in own.grams.items()}
        for batch in batches:
            n += batch.num_rows
            for _, texts in chunks(batch.column(1)):
                chance(texts, own, counts)
        yield pa.RecordBatch.from_pydict({"w": pa.array([0], pa.int32()), "gram": pa.array([0], pa.int32()), "n": pa.array([n], pa.int64())})
        for w, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({"w": pa.array(np.full(len(at), w), pa.int32()), "gram": pa.array(at, pa.int32()), "n": pa.array(c[at], pa.int64())})

    sums = docs.mapInArrow(count, "w int, gram int, n bigint").groupBy("w", "gram").agg(F.sum("n").alias("n")).where((F.col("w") == 0) | (F.col("n") >= STOCK)).toArrow()
    w, gram, n = (sums.column(c).to_numpy() for c in ("w", "gram", "n"))
    stock = n >= max(STOCK, STOCK_SHARE * n[w == 0].sum())
    for k, flags in block.rare.items():
        flags[gram[stock & (w == k)]] = False


LEAKS = "doc_id bigint, text_hash bigint, item_id bigint, held double, spans array<struct<start:int,stop:int>>"
ARROW_LEAKS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("held", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
WINDOWS = "doc_id bigint, text_hash bigint, n int, chars string, j int, start int, stop int"
GRAMS = "item_id bigint, size int, n int, chars string, i int, h bigint"


def _documents(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return documents.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _spelled(chars: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    """The windows of n characters at the given places, as texts."""
    flat = chars[(at[:, None] + np.arange(n)).ravel()] if len(at) else np.zeros(0, np.uint32)
    return from_codepoints(flat, np.arange(len(at) + 1, dtype=np.int64) * n)


def gram_rows(asked: DataFrame) -> DataFrame:
    """(item_id, size, n, chars, i, h) of every n-gram of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = Items([(item, text)])
                for n, (h, _, at) in one.grams.items():
                    cols = [np.full(len(h), item, np.int64), np.full(len(h), one.sizes[0], np.int32), np.full(len(h), n, np.int32)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), _spelled(one.chars, at, n), pa.array(at), pa.array(h.view(np.int64))], ["item_id", "size", "n", "chars", "i", "h"])

    return asked.mapInArrow(run, GRAMS)


def bit_map(grams: DataFrame, most: int) -> np.ndarray:
    """One bit for each value of the low bits of the grams' hashes; its size follows the number of grams up to 32 MB."""
    bits = min(28, max(16, int(most).bit_length() + 4))
    low = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    words = grams.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def joined_leaks(docs: DataFrame, asked: DataFrame, share: float) -> DataFrame:
    """The leaks of any number of items: sieved windows meet the grams in a join on their characters; LEAKS."""
    spark = docs.sparkSession
    grams = written(gram_rows(asked), "leak-grams")
    sizes = sorted(r["n"] for r in grams.select("n").distinct().collect())  # at most as many as the longest window
    shared = spark.sparkContext.broadcast((bit_map(grams, grams.count()), sizes))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, lengths = shared.value
        mask = np.uint64(len(flags) * 64 - 1)
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                codes, offsets = to_codepoints(texts)
                chars, rows, places = normalised(codes, offsets)
                for n in lengths:
                    h = window_hashes(chars, n)
                    low = h & mask
                    ok = np.flatnonzero((flags[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1))
                    row = np.searchsorted(rows, ok, side="right") - 1
                    inside = ok + n <= rows[row + 1]
                    ok, row = ok[inside], row[inside]
                    if len(ok):
                        take = pa.array(row + at)
                        local = (places[ok] - offsets[row]).astype(np.int32), (places[ok + n - 1] - offsets[row] + 1).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), pa.array(np.full(len(ok), n, np.int32)), _spelled(chars, ok, n), pa.array((ok - rows[row]).astype(np.int32)), *map(pa.array, local)], ["doc_id", "text_hash", "n", "chars", "j", "start", "stop"])

    met = written(docs.mapInArrow(windows, WINDOWS).distinct().join(grams.drop("h"), ["n", "chars"]).drop("chars"), "leak-hits")
    pair = ["doc_id", "text_hash", "item_id"]
    few = met.groupBy(*pair).agg(F.count(F.lit(1)).alias("c"), F.first("size").alias("s"), F.first("n").alias("w")).where(F.col("c") < CHANCE * (F.col("s") - F.col("w") + 1)).select(*pair)
    often = met.join(few, pair, "left_semi").select(*pair, "i").distinct().groupBy("item_id", "i").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(STOCK, STOCK_SHARE * docs.count())).select("item_id", "i", F.lit(False).alias("rare"))
    rows = met.join(often, ["item_id", "i"], "left").groupBy(*pair, "size", "n").agg(F.array_sort(F.collect_list(F.struct("j", "i", "start", "stop", F.coalesce("rare", F.lit(True)).alias("rare")))).alias("hits"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, item, size, n, found in zip(*(c.to_pylist() for c in batch.columns)):
                i, j = (np.array([x[k] for x in found]) for k in "ij")
                first, last = {x["j"]: x["start"] for x in found}, {x["j"] + n: x["stop"] for x in found}
                for held, chained in copies(i, j, n, size, np.array([x["rare"] for x in found]), share):
                    out.append((doc, text, item, min(1.0, held / size), [{"start": first[p[2]], "stop": last[p[3]]} for p in chained]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ARROW_LEAKS)], schema=ARROW_LEAKS)

    return rows.mapInArrow(judge, LEAKS)


def leaks(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = SHARE, max_grams: int = MAX_GRAMS) -> DataFrame:
    """(doc_id, text_hash, item_id, held, spans): every copy of at least `share` of an item in a document, and where it stands."""
    docs, asked = _documents(documents, id_col, text_col), _asked(items, item_id, item_text)
    block = block_of(asked, max_grams)
    if block is None:
        return joined_leaks(docs, asked, share)
    without_stock(docs, block)
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                out = [(batch.column(0)[at + r].as_py(), batch.column(2)[at + r].as_py(), k, held, [{"start": a, "stop": b} for a, b in spans]) for r, k, held, spans in scan(texts, own, share)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ARROW_LEAKS)], schema=ARROW_LEAKS)

    return docs.mapInArrow(run, LEAKS)


def leaked_pairs(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) of every leak."""
    return leaks(documents, items).select("doc_id", "item_id").distinct()


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans, which may overlap."""
    out, at = [], 0
    for a, b in sorted(spans):
        out.append(text[at : max(a, at)])
        at = max(at, b)
    return "".join([*out, text[at:]])


CLEANED = "doc_id bigint, text string, removed_chars int, leaked_items array<bigint>"
ARROW_CLEANED = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("removed_chars", pa.int32()), ("leaked_items", pa.list_(pa.int64()))])


def _cleaned(ids: list, texts: list, found: dict[int, list[tuple[int, list[tuple[int, int]]]]], drop_from: float) -> pa.RecordBatch:
    """The rows of a batch, cut by what was found in each (item, spans)."""
    out = []
    for r, (doc, text) in enumerate(zip(ids, texts)):
        if r not in found:
            out.append((doc, text, 0, None))
            continue
        short = cut_out(text, [s for _, spans in found[r] for s in spans])
        if len(text) - len(short) < drop_from * len(text):
            out.append((doc, short, len(text) - len(short), sorted({k for k, _ in found[r]})))
    cols = list(zip(*out)) if out else [[] for _ in ARROW_CLEANED]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ARROW_CLEANED)], schema=ARROW_CLEANED)


def without_leaks(documents: DataFrame, items: DataFrame, drop_from: float = 0.5, max_grams: int = MAX_GRAMS) -> DataFrame:
    """(doc_id, text, removed_chars, leaked_items): documents with every leaked span cut out.

    A document of which the spans make at least `drop_from` is dropped. The scan that finds the spans also cuts them: no text is
    shuffled. Only where the items are too many for a broadcast the spans, found by a join, meet the texts afterwards.
    """
    docs, asked = _documents(documents, "doc_id", "text"), _asked(items, "item_id", "text")
    block = block_of(asked, max_grams)
    if block is None:
        spans = written(joined_leaks(docs, asked, SHARE).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item_id", "spans")).alias("found")), "leak-spans")  # its size is known when the texts meet it

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = {r: [(x["item_id"], [(s["start"], s["stop"]) for s in x["spans"]]) for x in f] for r, f in enumerate(b.column(2).to_pylist()) if f}
                yield _cleaned(b.column(0).to_pylist(), b.column(1).to_pylist(), found, drop_from)

        return docs.join(spans, ["doc_id", "text_hash"], "left").select("doc_id", "text", "found").mapInArrow(cut, CLEANED)
    without_stock(docs, block)
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                found: dict[int, list] = {}
                for r, k, _, spans in scan(texts, own):
                    found.setdefault(r, []).append((k, spans))
                yield _cleaned(batch.column(0).slice(at, len(texts)).to_pylist(), texts.to_pylist(), found, drop_from)

    return docs.mapInArrow(run, CLEANED)
