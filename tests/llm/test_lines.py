import json
import math

from pyspark.sql import functions as F

from folianth.llm import site_lines as S


def frame(spark):
    rows, n = [], 0
    for source, books, own in (("a", 12, 5), ("b", 8, 2), (None, 5, 5)):
        for k in range(books):
            n += 1
            lines = [f"Only {source} {k} once {'x' * k}", f"Share　No. {k}" if k < own else "other " + chr(97 + k), "Page 1"]
            rows.append((n, f"{source}{k}", source, k, "text", json.dumps({"text": "\n".join(lines)})))
    rows += [rows[0], (90, "a0", "a", 9, "text", json.dumps({"text": "ＳＨＡＲＥ no.77", "text_level": 1})), (91, "a0", "a", 10, "text", "{"), (92, "a0", "a", 11, "text", None), (93, "a1", "a", 12, "table", json.dumps({"text": "share no. 1"})), (94, "a2", "a", 13, "text", json.dumps({"text": ""}))]
    return spark.createDataFrame([(*r[:5], None, r[5], "clash") for r in rows], "block_id bigint, book string, source string, seq int, type string, page_idx int, item string, key string")


def test_places(spark):
    df = frame(spark)
    got = {tuple(r) for r in S.excess_places(df).collect()}
    assert got == {(i, 2) for i in range(1, 6)}  # five of twelve books of a; two of eight of b are too few
    e = S.excess(df).collect()
    assert [(r.source, r.inside, r.books, r.outside) for r in e] == [("a", 5, 12, 2)]
    kept = {r.block_id: r.text for r in S.without_excess(df).collect()}
    assert "Share" not in kept[1] and kept[1].endswith("Page 1") and "Share" in kept[13] and 94 in kept and 91 not in kept
    assert S.excess_places(df.limit(0)).count() == 0 and S.excess(df.limit(0)).count() == 0


def test_likelihood_ratio(spark):
    def plain(k1, n1, k2, n2):
        term = lambda k, n, p: (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)
        p = (k1 + k2) / (n1 + n2)
        return 2 * (term(k1, n1, k1 / n1) + term(k2, n2, k2 / n2) - term(k1, n1, p) - term(k2, n2, p))

    cases = [(5, 12, 2, 8), (12, 12, 0, 8), (3, 12, 3, 12)]
    df = spark.createDataFrame(cases, "a int, b int, c int, d int").select(S.log_likelihood_ratio(*(F.col(x) for x in "abcd")).alias("g"))
    for (g,), c in zip(df.collect(), cases):
        assert abs(g - plain(*c)) < 1e-5
    ratios = spark.createDataFrame([(40.0,), (30.0,), (0.1,), (0.2,), (-3.0,)], "llr double")
    assert 5 < S.discovery_threshold(ratios) <= 30
    many = ratios.union(spark.range(2_000_000).selectExpr("-1.0D"))  # tests without excess count as tests
    assert S.discovery_threshold(many) > 25


def test_heads_and_verdicts(spark):
    rows, n = [], 0
    for k in range(6):
        for text, box in ((f"Head of it {k}", [0, 20, 9, 30]), (f"Head of it {k + 5}\nown text {'y' * k}\nshared  line", None), (f"shared Line {k}", None)):
            n += 1
            rows.append((n, f"b{k}", "s", n, "text", None, json.dumps({"text": text} | ({"bbox": box} if box else {}))))
    df = spark.createDataFrame(rows, "block_id bigint, book string, source string, seq int, type string, page_idx int, item string")
    got = {tuple(r) for r in S.excess_places(df).collect()}
    assert got == {(i, 3) for i in range(2, 19, 3)} | {(i, 1) for i in range(3, 19, 3)}
    e = S.Excess(df)
    assert sum(r.lines for r in e.verdicts().collect() if r.named) >= 1
    kept = {r.block_id: r.text for r in e.removed().collect()}
    assert kept[2] == "Head of it 5\nown text " and 3 not in kept and kept[1] == "Head of it 0" and len(kept) == 12
