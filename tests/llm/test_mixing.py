from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from folianth.llm import mixing as M


def frames(spark):
    docs = [(i, "hot" if i % 3 else "b", f"text number {i} of the source " * (1 + i % 7)) for i in range(300)] + [(900, "tiny", "few words here"), (901, None, "no source"), (902, "hot", None), (903, "hot", ""), (904, "untargeted", "x y z"), (905, "b", "long " * 60_000)]
    targets = [("hot", 0.5, 1), ("b", 0.2, 2), ("tiny", 0.0, 3), ("missing", 0.2, 3), (None, 0.1, 1), ("b", 0.1, 3)]
    return spark.createDataFrame([(*d, "c") for d in docs], "doc_id bigint, source string, text string, tokens string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_mixture(spark):
    docs, targets = frames(spark)
    m = M.Mixture(docs, targets, block_tokens=32, shards=4, total_blocks=M.EXACT)
    drawn = m.drawn.collect()
    report = {r.source: r for r in m.report.collect()}
    assert abs(report["hot"].reached_share - 0.5 / 0.8) < 0.02 and abs(report["b"].reached_share - 0.3 / 0.8) < 0.02
    assert report["missing"].drawn_tokens == 0 and report["untargeted"].drawn_tokens == 0 and report[None].drawn_tokens == 0 and report["hot"].most_uses == 1
    uses = Counter((r.source, r.block, r.doc_id, r.token_from) for r in drawn)
    assert max(v for k, v in uses.items() if k[0] == "hot") == 1 and max(v for k, v in uses.items() if k[0] == "b") <= 2
    assert len({(r.shard, r.slot) for r in drawn}) == sum(n for _, n in m.planned.values())
    used = {r.doc_id: r for r in M.document_uses(docs, targets, block_tokens=32, shards=4, total_blocks=M.EXACT).collect()}
    assert used[902].most_uses == 0 and all(r.most_uses <= {"hot": 1, "b": 2}.get(r.source, 0) for r in used.values()) and sum(r.drawn_tokens for r in used.values()) == sum(r.token_to - r.token_from for r in drawn)
    packed = M.packed(m.drawn, docs).collect()
    sizes = Counter(len(r.token_ids) for r in packed)
    assert max(sizes) == 32 and sum(v for k, v in sizes.items() if k < 32) <= 4
    assert M.mixture(docs.limit(0), targets).count() == 0 and M.mixture(docs, targets.limit(0)).count() == 0
    again = M.Mixture(docs, targets, block_tokens=32, shards=4, total_blocks=M.EXACT).drawn
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, drawn))


def test_streams_are_packed_without_loss(spark):
    docs, _ = frames(spark)
    counts = M.counted(docs)
    pieces = M.pieces(M.placed(counts, docs_per_bucket=20), 32)
    by_doc = pieces.groupBy("doc_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("n"))
    assert by_doc.join(counts.where("source is not null"), "doc_id").where("n <> tokens").count() == 0
    full = pieces.groupBy("source", "block").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("n")).where("n < 32").groupBy("source").count().collect()
    assert all(r["count"] == 1 for r in full)


def test_permutations_and_plans():
    for n in (1, 2, 3, 17, 64, 1000):
        k = np.arange(n)
        assert sorted(M.permuted(k, np.full(n, n), np.full(n, 12345)).tolist()) == list(range(n))
    assert M.plan({}, [("a", 0.5, 1)]) == {} and M.plan({"a": 100}, [("a", None, 1), ("a", 0.5, None)]) == {}
    assert M.plan({"a": 1000, "b": 100}, [("a", 0.5, 1), ("b", 0.5, 2)], 10, M.EXACT) == {"a": (100, 20), "b": (10, 20)}
    assert M.plan({"a": 1000, "b": 100}, [("a", 0.5, 1), ("b", 0.5, 2)], 10, total_blocks=100) == {"a": (100, 80), "b": (10, 20)}
    assert M.plan({"a": 1000, "b": 100, "c": 1000}, [("a", 0.4, 1), ("b", 0.2, 1), ("c", 0.4, 9)], 10) == {"a": (100, 100), "b": (10, 10), "c": (100, 100)}
    assert M.plan({"a": 30, "b": 100}, [("a", 0.5, 1), ("b", 0.5, 1)], 10, total_blocks=10**9) == {"a": (3, 3), "b": (10, 10)}
    counts = M.shard_counts([10, 0, 7], 4, 1)
    assert counts.sum(axis=0).tolist() == [10, 0, 7] and max(counts.sum(axis=1)) - min(counts.sum(axis=1)) <= 2
    long = "wörter und 字 12, " * 40_000 + "x" * 200_000
    assert len(long) > 800_000 and M.encode(long) == M.tokenizer().encode_ordinary(long) and M.tokenizer().decode(M.encode(long)) == long


def test_whole_size_mixture(spark):
    docs, targets = frames(spark)
    assert {r.name: r.holds for r in M.checks(docs, targets, block_tokens=32).collect()} == dict.fromkeys(("caps", "slots", "blocks", "shares", "whole"), True)
    m = M.Mixture(docs, targets, block_tokens=32)
    report = {r.source: r for r in m.report.collect()}
    assert m.planned["hot"][1] == m.planned["hot"][0] and report["hot"].reached_share < 0.5 and report["hot"].most_uses == 1  # all it may give
    assert sum(n for _, n in m.planned.values()) == sum(n for n, _ in m.planned.values()) and report["b"].most_uses <= 2
