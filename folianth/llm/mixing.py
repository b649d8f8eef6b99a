"""Problem 7: a mixture of sources that meets target shares of all tokens.

Texts are tokenized whole by a public tokenizer (the package `public_tokenizers` with the vocabulary files, or the path of a rank file).
The tokens of a source, its documents in a fixed order, form one stream that
is packed into blocks of `block_tokens` (the last may be shorter), so nothing is cut off. How many blocks each source
gives follows from the targets; the counts of each output shard are a multinomial draw conditioned on those totals, so
the reached shares are exact to one block. A slot of a source maps to a block through the source's own pseudorandom
permutation, a new one for each use, so no block (and no document) is used more than `max_repeats` times before
or beyond the cap. Slots and blocks meet in a join on (source, block).

The size is `total_blocks`, by default all blocks of the sources with a target: as many tokens as there are. A source that can't give
its share within its cap gives all it may, what is missing is given out over the others in proportion to their shares, and the report
shows target and reached share of each. `EXACT` as the size asks instead for the largest mixture that meets every share within every cap; the
scarcest source then sets it. Sources without a target, with a null name or without a token give nothing; a target whose source
has no token can't be met and is shared out in proportion, which the report shows as reached share 0.

Prefix sums run over (source, bucket of documents) and the few bucket totals, so that one source with a third of all rows
is no single task. What reaches the driver are the totals by source (as many rows as targets).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folianth.sources.tables import written

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
BLOCK_TOKENS = 128
#: A shard holds about so many blocks; a small mixture has at least SHARDS shards.
BLOCKS_PER_SHARD, SHARDS = 1 << 20, 16
EXACT = -1
SEED = 42
DOCS_PER_BUCKET = 200_000
_cache: dict = {}


def tokenizer(path: str | None = None):
    """The tokenizer of a rank file: a path, or the name of a file of the installed public tokenizers."""
    name = path or TOKENIZER
    if name not in _cache:
        import base64
        import os

        import public_tokenizers as public
        import tiktoken

        file = name if os.path.exists(name) else public.path(name)
        with open(file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _cache[name] = tiktoken.Encoding(os.path.basename(name), pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _cache[name]


def encode(text: str, path: str | None = None) -> list[int]:
    """Token ids of a whole text of any length."""
    return tokenizer(path).encode_ordinary(text)


def counted(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, source, tokens) of every document; a null text has 0 tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [len(encode(x, tokenizer_path)) if x else 0 for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64())], ["doc_id", "source", "tokens"])

    return documents.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, source string, tokens bigint")


def placed(counts: DataFrame, docs_per_bucket: int = DOCS_PER_BUCKET) -> DataFrame:
    """`counts` with the place of each document in its source's token stream: (doc_id, source, tokens, start)."""
    most = counts.count()
    buckets = max(8, -(-most // docs_per_bucket))
    c = counts.where((F.col("tokens") > 0) & F.col("source").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    inner = Window.partitionBy("source", "bucket").orderBy("doc_id", "tokens")
    totals = c.groupBy("source", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    base = totals.withColumn("base", F.sum("bucket_tokens").over(Window.partitionBy("source").orderBy("bucket")) - F.col("bucket_tokens")).drop("bucket_tokens")
    local = c.withColumn("local", F.sum("tokens").over(inner.rowsBetween(Window.unboundedPreceding, -1)))
    return local.join(base, ["source", "bucket"]).select("doc_id", "source", "tokens", (F.col("base") + F.coalesce("local", F.lit(0))).alias("start"))


def pieces(places: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(source, block, doc_id, token_from, token_to): what each block holds of each document."""
    size = F.lit(block_tokens)
    stop = F.col("start") + F.col("tokens")
    each = places.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((stop - 1) / size))))
    lo, hi = F.greatest(F.col("block") * size, F.col("start")), F.least((F.col("block") + 1) * size, stop)
    return each.select("source", "block", "doc_id", (lo - F.col("start")).alias("token_from"), (hi - F.col("start")).alias("token_to"))


def plan(totals: dict[str, int], targets: list[tuple[str, float, int]], block_tokens: int = BLOCK_TOKENS, total_blocks: int | None = None) -> dict[str, tuple[int, int]]:
    """(blocks held, blocks to draw) by source.

    A null share, a share of 0 or less and a null or negative cap count as no target; of a source named twice the shares
    add up and the smaller cap holds.
    """
    wanted: dict[str, tuple[float, int]] = {}
    for source, share, cap in targets:
        if source is not None and share and share > 0 and cap and cap > 0:
            s, k = wanted.get(source, (0.0, cap))
            wanted[source] = (s + share, min(k, cap))
    held = {s: -(-totals[s] // block_tokens) for s in wanted if totals.get(s, 0) > 0}
    mass = sum(wanted[s][0] for s in held)
    if not held:
        return {}
    shares = {s: wanted[s][0] / mass for s in held}
    caps = {s: wanted[s][1] * held[s] for s in held}
    size = min(int(caps[s] / shares[s]) for s in held) if total_blocks == EXACT else min(sum(held.values()) if total_blocks is None else total_blocks, sum(caps.values()))
    # what capped sources can't give goes to the others in proportion, until no other is capped by it
    capped: set[str] = set()
    while True:
        open_mass = sum(shares[s] for s in held if s not in capped)
        left = size - sum(caps[s] for s in capped)
        over = {s for s in held if s not in capped and left * shares[s] / open_mass > caps[s]}
        if not over:
            break
        capped |= over
    exact = {s: float(caps[s]) if s in capped else left * shares[s] / open_mass for s in held}
    draw = {s: int(exact[s]) for s in held}
    for s in sorted((s for s in held if draw[s] < caps[s]), key=lambda s: (draw[s] - exact[s], s))[: size - sum(draw.values())]:  # largest remainders
        draw[s] += 1
    return {s: (held[s], draw[s]) for s in sorted(held)}


def permuted(k: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(n) for each key: four Feistel rounds, walked until inside the range."""
    n64, key = n.astype(np.uint64), key.astype(np.uint64)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n64, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, open_ = k.astype(np.uint64).copy(), np.ones(len(k), bool)
    with np.errstate(over="ignore"):
        while open_.any():
            a, b = out[open_] >> half[open_], out[open_] & mask[open_]
            for r in range(4):
                h = (b + key[open_]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03) * np.uint64(r + 1)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                a, b = b, a ^ ((h ^ (h >> np.uint64(32))) & mask[open_])
            out[open_] = (a << half[open_]) | b
            open_ &= out >= n64
    return out.astype(np.int64)


def shard_counts(drawn: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks by (shard, source): multinomial draws for one shard after another, conditioned on the totals."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left, out = np.array(drawn, np.int64), []
    for k in range(shards, 0, -1):
        size = int(left.sum()) // k if k > 1 else int(left.sum())
        take = rng.multivariate_hypergeometric(left, size, method="marginals") if size else np.zeros_like(left)
        out.append(take)
        left = left - take
    return np.array(out, np.int64).reshape(shards, len(drawn))


def slots(spark, planned: dict[str, tuple[int, int]], shards: int | None = None, seed: int = SEED) -> DataFrame:
    """(shard, slot, source, use_no, block): the drawn blocks, each slot computed on its own."""
    names = list(planned)
    shards = shards or max(SHARDS, -(-sum(d for _, d in planned.values()) // BLOCKS_PER_SHARD))
    held = np.array([planned[s][0] for s in names], np.int64)
    counts = shard_counts([planned[s][1] for s in names], shards, seed) if names else np.zeros((shards, 0), np.int64)
    before = np.cumsum(counts, axis=0) - counts  # slots of each source in earlier shards
    starts = np.concatenate([[0], np.cumsum(counts.sum(axis=1))])
    inner = np.cumsum(counts, axis=1)
    schema = "shard int, slot bigint, source string, use_no int, block bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            shard = np.searchsorted(starts, ids, side="right") - 1
            sizes = starts[shard + 1] - starts[shard]
            mixed = permuted(ids - starts[shard], sizes, (shard + 1) * 7919 + seed)
            source = (inner[shard] <= mixed[:, None]).sum(axis=1)
            k = before[shard, source] + mixed - (inner[shard, source] - counts[shard, source])
            use, place = k // held[source], k % held[source]
            block = permuted(place, held[source], (source + 1) * 104_729 + use * 1_299_709 + seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(ids - starts[shard]), pa.array(np.array(names, object)[source], pa.string()), pa.array(use + 1, pa.int32()), pa.array(block)],
                ["shard", "slot", "source", "use_no", "block"],
            )

    return spark.range(int(starts[-1])).mapInArrow(run, schema)


class Mixture:
    """A planned mixture: `drawn` (pieces of documents by shard and slot) and `report` (shares by source)."""

    def __init__(self, documents: DataFrame, targets: DataFrame, tokenizer_path: str | None = None, block_tokens: int = BLOCK_TOKENS, shards: int | None = None, seed: int = SEED, total_blocks: int | None = None):
        spark = documents.sparkSession
        self.targets = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
        # tokenizing is the one costly step: its counts are written once, then read by every later pass
        self.counts = written(counted(documents, tokenizer_path), "token-counts")
        self.by_source = self.counts.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
        wanted = self.targets.where(F.col("source").isNotNull())
        rows = wanted.join(self.by_source, "source", "left").select("source", "target_share", "max_repeats", "tokens").collect()
        self.caps = {r["source"]: r["max_repeats"] for r in rows}
        self.planned = plan({r["source"]: r["tokens"] or 0 for r in rows}, [(r["source"], r["target_share"], r["max_repeats"]) for r in rows], block_tokens, total_blocks)
        self.pieces = pieces(placed(self.counts.where(F.col("source").isin(list(self.planned)))), block_tokens)
        self.slots = slots(spark, self.planned, shards, seed)

    @property
    def drawn(self) -> DataFrame:
        """(shard, slot, source, use_no, block, doc_id, token_from, token_to)."""
        return self.slots.join(self.pieces, ["source", "block"]).select("shard", "slot", "source", "use_no", "block", "doc_id", "token_from", "token_to")

    @property
    def report(self) -> DataFrame:
        """One row for each source that has a target or documents."""
        drawn = self.drawn.groupBy("source").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("drawn_tokens"), F.max("use_no").alias("most_uses"))
        both = self.by_source.join(self.targets, self.by_source["source"].eqNullSafe(self.targets["source"]), "full").select(F.coalesce(self.by_source["source"], self.targets["source"]).alias("source"), "documents", "tokens", "target_share", "max_repeats")
        return (
            both.join(drawn, "source", "left").withColumn("all_tokens", F.sum("drawn_tokens").over(Window.partitionBy()))  # a row for each source
            .select(
                "source", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), "max_repeats",
                F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"), F.round(F.coalesce("drawn_tokens", F.lit(0)) / F.col("all_tokens"), 6).alias("reached_share"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
            )
        )


def checks(documents: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """(name, holds): what must hold for every mixture, told from the drawn pieces themselves.

    `caps`: no piece of a document is drawn more often than its source's cap; `slots`: the drawn blocks are all different slots and as many as
    planned; `blocks`: no drawn block but the last of a source is short; `shares`: uncapped sources stand to each other as their targets,
    to one block each; `whole`: packing loses no token.
    """
    m = Mixture(documents, targets, **options)
    drawn, size = m.drawn, options.get("block_tokens", BLOCK_TOKENS)
    uses = drawn.groupBy("source", "block", "doc_id", "token_from").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.max("n").alias("n"))
    caps = uses.join(m.targets, "source").agg(F.coalesce(F.bool_and(F.col("n") <= F.col("max_repeats")), F.lit(True)).alias("holds"))
    blocks = drawn.groupBy("source", "shard", "slot", "block").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("n"))
    planned = sum(d for _, d in m.planned.values())
    slots_ = blocks.agg(((F.count(F.lit(1)) == planned) & (F.count_distinct("shard", "slot") == planned)).alias("holds"))
    full = blocks.where(F.col("n") < size).select("source", "block").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n") <= 1, F.lit(True)).alias("holds"))
    loose = {r["source"]: r["target_share"] for r in m.targets.where(F.col("source").isin(list(m.planned))).collect()}
    free = [s for s, (held, drew) in m.planned.items() if drew < held * m.caps[s] - 1]
    unit = sum(m.planned[s][1] for s in free) / (sum(loose[s] for s in free) or 1.0)
    shares_ = documents.sparkSession.range(1).select(F.lit(all(abs(m.planned[s][1] - unit * loose[s]) <= len(free) + 1 for s in free)).alias("holds"))
    lost = m.pieces.groupBy("doc_id", "source").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("n")).join(m.counts.groupBy("doc_id", "source").agg(F.sum("tokens").alias("tokens")), ["doc_id", "source"]).agg(F.coalesce(F.bool_and(F.col("n") == F.col("tokens")), F.lit(True)).alias("holds"))
    out = None
    for name, one in (("caps", caps), ("slots", slots_), ("blocks", full), ("shares", shares_), ("whole", lost)):
        row = one.select(F.lit(name).alias("name"), "holds")
        out = row if out is None else out.unionByName(row)
    return out


def mixture(documents: DataFrame, targets: DataFrame, **options) -> DataFrame:
    return Mixture(documents, targets, **options).drawn


def shares(documents: DataFrame, targets: DataFrame, **options) -> DataFrame:
    return Mixture(documents, targets, **options).report


def document_uses(documents: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """(doc_id, source, tokens, drawn_tokens, most_uses): how much of each document is drawn, and how often the part that is drawn most."""
    m = Mixture(documents, targets, **options)
    parts = m.drawn.groupBy("doc_id", "token_from", "token_to").agg(F.count(F.lit(1)).alias("uses"))
    used = parts.groupBy("doc_id").agg(F.sum(F.col("uses") * (F.col("token_to") - F.col("token_from"))).alias("drawn_tokens"), F.max("uses").alias("most_uses"))
    return m.counts.join(used, "doc_id", "left").select("doc_id", "source", "tokens", F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"))


def packed(drawn: DataFrame, documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(shard, slot, source, token_ids): the drawn blocks with their tokens.

    Each document that is drawn is tokenized once, where it meets its pieces; no document is sent twice.
    """
    wanted = drawn.groupBy("doc_id").agg(F.collect_list(F.struct("shard", "slot", "source", "token_from", "token_to")).alias("uses"))
    joined = wanted.join(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id").select("doc_id", "text", "uses")
    schema = "shard int, slot bigint, source string, doc_id bigint, token_from bigint, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, uses in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids = encode(text or "", tokenizer_path)
                rows += [(u["shard"], u["slot"], u["source"], doc, u["token_from"], ids[u["token_from"] : u["token_to"]]) for u in uses]
            cols = list(zip(*rows)) if rows else [[] for _ in range(6)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())))], ["shard", "slot", "source", "doc_id", "token_from", "ids"])

    parts = joined.mapInArrow(run, schema)
    return parts.groupBy("shard", "slot", "source").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "token_from", "ids"))), lambda x: x["ids"])).alias("token_ids"))
