import random

import pyarrow as pa

from folianth.llm import leakage as L

EN = "When the harbour lamps were finally lit the old printer carried nine heavy proofs across the wet bridge and left them beside the second window of the empty reading room before anybody noticed"
ZH = "清晨的第一场雪落在石桥上，印工抱着九份校样走过空荡荡的集市，把它们放在阅览室第二扇窗旁边，直到傍晚也没有人发现这件事情"
OTHER = "Nothing here repeats anything else although the sentences are long enough to be scanned for a while by every window of the search"


def test_cases(spark):
    words = EN.split()
    changed = [w if i % 9 else "instead" for i, w in enumerate(words)]
    docs = [
        (1, f"Before. {EN} After."), (2, OTHER), (3, " ".join(words[: len(words) // 2])), (4, " ".join(words[:5])), (5, EN.upper().replace(" ", "\n") + "!"), (6, " ".join(changed)), (7, "“" + ZH.replace("，", "\n，") + "”"), (8, ZH[: len(ZH) // 2] + OTHER), (9, ZH[:9]),
        (10, " ".join(words[:9]) + ". " + OTHER + ". " + " ".join(words[9:20])), (11, " ".join(words[20:]) + " " + OTHER + " " + " ".join(words[:5])), (12, None), (13, ""), (14, OTHER * 2000 + EN), (15, EN.translate({ord(c): ord(c) + 0xFEE0 for c in "abcdefgh"})),
    ]
    docs += [(1, docs[0][1])]
    items = [(100, EN, "x"), (101, ZH, "x"), (102, None, "x"), (103, "", "x"), (104, "!?", "x")]
    d, i = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id bigint, text string, item_id string"), spark.createDataFrame(items, "item_id bigint, text string, doc_id string")
    want = {(k, 100) for k in (1, 3, 5, 6, 10, 11, 14, 15)} | {(7, 101), (8, 101)}
    assert {tuple(r) for r in L.leaked_pairs(d, i).collect()} == want
    assert {(r.doc_id, r.item_id) for r in L.leaks(d, i, max_grams=10).select("doc_id", "item_id").distinct().collect()} == want
    for most in (L.MAX_GRAMS, 10):  # by the broadcast, and by the join
        clean = {r.doc_id: r.text for r in L.without_leaks(d.where("doc_id in (2, 8, 12, 14)"), i, max_grams=most).collect()}
        assert clean[2] == OTHER and clean[12] is None and clean[8] == OTHER and clean[14] == OTHER * 2000
    assert L.leaks(d.limit(0), i, max_grams=10).count() == 0
    assert L.leaked_pairs(d.limit(0), i).count() == 0 and L.leaked_pairs(d, i.limit(0)).count() == 0


def test_windows_find_every_repeat():
    import numpy as np

    rng = random.Random(4)
    chars = np.array([rng.randint(1, 3) for _ in range(400)], np.uint32)
    for n in (1, 3, 6):
        h = L.window_hashes(chars, n)
        same = {}
        for k in range(len(chars) - n + 1):
            same.setdefault(tuple(chars[k : k + n].tolist()), set()).add(int(h[k]))
        assert all(len(v) == 1 for v in same.values()) and len({x for v in same.values() for x in v}) == len(same)
    assert len(L.window_hashes(chars[:2], 3)) == 0


def test_pieces_far_apart_are_added_up(spark):
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n))
    item, phrase = words(50), words(8)
    w = item.split()
    stock = words(20) + " " + phrase + " " + words(12)  # of 40 words, 8 are a stock phrase of the corpus
    three = [words(60).join(["", " ".join(w[:7]), " ".join(w[20:27]), " ".join(w[40:47]), ""])]  # three runs of 42 letters, 42 % of 300
    five = [words(60).join(["", *(" ".join(w[k : k + 4]) for k in (0, 10, 20, 30, 40)), ""])]  # five runs of 24 letters: one window each, 40 %
    third = [words(60).join(["", " ".join(w[:8]), " ".join(w[20:28]), ""])]
    docs = [*three, *five, *third, *(f"{words(30)} {phrase} {words(30)}" for _ in range(5))]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    i = spark.createDataFrame([(1, item), (2, stock)], "item_id bigint, text string")
    assert sorted(map(tuple, L.leaked_pairs(d, i).collect())) == [(0, 1), (1, 1)]


def test_many_open_pieces_do_not_hide_a_leak():
    import numpy as np

    # the item repeats one window at 60 places far from the leak: between two windows of the leak 60 other pieces open
    n = 6
    far = np.arange(60) * 40 + 1000
    i, j = np.concatenate([[0], far, [6]]), np.concatenate([[0], np.full(60, 3), [6]])
    assert (0, 12, 0, 12) in L.pieces(i, j, n)


def test_every_copy_is_cut(spark):
    twice = f"{OTHER} {EN} {OTHER} {EN.upper()} {OTHER}"
    d = spark.createDataFrame([(1, twice), (2, f"{ZH}{OTHER * 4}{ZH}{ZH}")], "doc_id bigint, text string")
    i = spark.createDataFrame([(100, EN), (101, ZH)], "item_id bigint, text string")
    for most in (L.MAX_GRAMS, 10):
        got = {r.doc_id: (r.text, r.leaked_items) for r in L.without_leaks(d, i, drop_from=0.9, max_grams=most).collect()}
        assert got[1][0].split() == f"{OTHER} {OTHER} {OTHER}".split() and got[1][1] == [100] and got[2] == (OTHER * 4, [101])
        assert sorted((r.doc_id, r.item_id, len(r.spans)) for r in L.leaks(d, i, max_grams=most).collect()) == [(1, 100, 1), (1, 100, 1), (2, 101, 1), (2, 101, 1), (2, 101, 1)]


def test_equal_hashes_are_compared(spark):
    import numpy as np

    items = L.Items([(1, EN)])
    other = L.Items([(1, OTHER)])
    items.chars = np.resize(other.chars, len(items.chars))  # the hashes still match, the characters don't
    assert len(L.hits(pa.array([EN]), items)[0]) > 0 and not list(L.scan(pa.array([EN]), items)) and list(L.scan(pa.array([EN]), L.Items([(1, EN)])))
    assert L.cut_out("abcdef", [(1, 3), (2, 4)]) == "aef"


def test_changed_words_are_bridged():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 8)))
    texts = [[word() for _ in range(40)] for _ in range(60)]
    items = L.Items([(k, " ".join(t)) for k, t in enumerate(texts)])
    for every in (8, 6, 5, 4):
        docs = pa.array([" ".join([word() for _ in range(9)] + [w if i % every else word() for i, w in enumerate(t)] + [word() for _ in range(9)]) for t in texts])
        found = {(r, k) for r, k, _, _ in L.scan(docs, items)}
        print(f"every {every}th word changed: {len(found & {(k, k) for k in range(60)})} of 60 found, {len(found - {(k, k) for k in range(60)})} wrong")
        assert len(found & {(k, k) for k in range(60)}) >= 54 and not found - {(k, k) for k in range(60)}
