"""Mixing sources to target weights with exact block quotas per output shard.

A source's documents are put in a fixed pseudo-random order and cut into blocks
(ranges of a hash). Targets share 100 % of all sizes by weight, at most
``max_repeats`` times a source's size, the excess reshared. A source gives whole
passes over its blocks plus, in a last pass, blocks up to its target; in the one
block where the target falls, documents up to it. So the blocks that a source
gives are an exact count, and a splitting tree deals these counts to the output
shards: each node draws its left half's share of every source's blocks from a
multivariate hypergeometric distribution, as if all blocks were shuffled and
dealt. A shard then takes its quota as the next blocks of a permutation of the
source's blocks (disjoint by construction) and orders its rows by hash.

The driver holds one number per source and shard (the quotas), never documents
or blocks; ``shard_words`` sets the number of shards.

Defined cases: a null text has size 0; sources rank by code point, null last; a
source of size 0 gives nothing; rows with equal doc_id and source lie in the same
block and are taken alike; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, words

MAX_REPEATS = 3
SHARD_WORDS = 4_000_000
BLOCKS_PER_SHARD = 32
SEED = 20


def cycle_weights(rank: int) -> float:
    """1, 2, 3, repeating, by the source's rank."""
    return rank % 3 + 1.0


def targets(sizes: list[int], weights: list[float], max_repeats: float = MAX_REPEATS) -> list[float]:
    """Shares of the total size by weight, none above ``max_repeats`` times its size."""
    out, total = [0.0] * len(sizes), float(sum(sizes))
    open_, left = [i for i, w in enumerate(weights) if w > 0], total
    while open_:
        whole = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / whole > max_repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / whole
            break
        for i in over:
            out[i] = float(max_repeats * sizes[i])
        open_ = [i for i in open_ if i not in set(over)]
        left = total - sum(out)
    return out


def split_quotas(blocks: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Blocks per (shard, source): rows add up to near equal block counts, columns to
    ``blocks`` exactly. Every node's draw is seeded by its place in the tree."""
    out = np.zeros((n_shards, len(blocks)), dtype=np.int64)
    todo = [(0, n_shards, np.asarray(blocks, dtype=np.int64))]
    while todo:
        low, high, have = todo.pop()
        if high - low == 1:
            out[low] = have
            continue
        mid, total = (low + high) // 2, int(have.sum())
        take = total * (mid - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if total else have * 0
        todo += [(low, mid, left), (mid, high, have - left)]
    return out


def _u(seed: int) -> Column:
    """A document's place in its source's order: 0 to 2^62."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("__doc"), F.col("__src")), 2)


def _pass_order(n_blocks: Column, block: Column, rep: Column) -> Column:
    """A block's place in a pass: every pass permutes the blocks its own way."""
    step = F.lit(2_147_483_647)  # a prime above any number of blocks, so it permutes them
    return F.pmod(block * F.pmod(step, n_blocks) + rep * F.lit(7919), n_blocks)


class Mix:
    """The plan of a mix: which blocks of which source go to which shard, how often."""

    def __init__(self, sources: DataFrame, deal: DataFrame, edge: DataFrame, n_shards: int, totals: list[tuple]):
        self.sources, self.deal, self.edge, self.n_shards, self.totals = sources, deal, edge, n_shards, totals


def measured(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with ``size``: the number of words of the whole text."""
    keep = [c for c in docs.columns if c != "size"]
    return docs.select(*keep, F.size(words(F.col(text))).cast("long").alias("size"))


def plan_mix(sized: DataFrame, weights: Callable[[int], float] = cycle_weights, doc_id: str = "doc_id", source: str = "source",
             seed: int = SEED, max_repeats: int = MAX_REPEATS, shard_words: int = SHARD_WORDS,
             blocks_per_shard: int = BLOCKS_PER_SHARD) -> Mix:
    """``sized`` holds doc_id, source and size."""
    spark = sized.sparkSession
    narrow = sized.select(F.col(doc_id).alias("__doc"), F.col(source).alias("__src"), F.col("size").alias("__size")).withColumn("__u", _u(seed))
    rows = sorted(narrow.groupBy("__src").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n")).collect(),
                  key=lambda r: (r["__src"] is None, r["__src"] or ""))
    sizes, total = [int(r["size"]) for r in rows], sum(int(r["size"]) for r in rows)
    target = targets(sizes, [weights(i) for i in range(len(rows))], max_repeats)
    n_shards = max(1, ceil(total / shard_words))
    per_word = n_shards * blocks_per_shard / max(total, 1)
    n_blocks = [max(1, min(int(r["n"]), round(s * per_word))) for r, s in zip(rows, sizes)]
    passes = [min(int(t // s), max_repeats) if s else 0 for t, s in zip(target, sizes)]
    rest = [t - p * s for t, p, s in zip(target, passes, sizes)]
    schema = "__src string, source_rank int, n_blocks long, source_size long, target double, passes long, rest double"
    sources = spark.createDataFrame([(r["__src"], i, n_blocks[i], sizes[i], target[i], passes[i], rest[i]) for i, r in enumerate(rows)], schema)
    blocks = (with_source(narrow, sources).groupBy("source_rank", "__block")
              .agg(F.sum("__size").alias("words"), F.first("n_blocks").alias("n_blocks"), F.first("passes").alias("passes"), F.first("rest").alias("rest")))
    blocks = blocks.withColumn("at", _pass_order(F.col("n_blocks"), F.col("__block"), F.col("passes")))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source_rank").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = blocks.withColumn("before", before).filter((F.col("rest") > 0) & (F.col("before") < F.col("rest")))
    # the last block that begins before the target is the one it falls in
    ends = {r["source_rank"]: r for r in last.groupBy("source_rank").agg(
        F.max(F.struct("before", "at", "__block")).alias("edge"), F.count(F.lit(1)).alias("n")).collect()}
    edge = spark.createDataFrame([(i, int(e["edge"]["__block"]), float(rest[i] - e["edge"]["before"])) for i, e in ends.items()],
                                 "source_rank int, __edge long, __room double")
    # whole passes, then the last pass up to the block that the target falls in
    given = [passes[i] * n_blocks[i] + (int(ends[i]["edge"]["at"]) + 1 if i in ends else 0) for i in range(len(rows))]
    quota = split_quotas(np.array(given, dtype=np.int64), n_shards, seed)
    upto = np.cumsum(quota, axis=0)
    deal = [(int(s), i, int(upto[s, i] - quota[s, i]), int(upto[s, i])) for s in range(n_shards) for i in range(len(rows)) if quota[s, i]]
    deal = spark.createDataFrame(deal, "shard long, source_rank int, low long, high long")
    return Mix(sources, deal, edge, n_shards, list(zip([r["__src"] for r in rows], sizes, target, strict=True)))


def with_source(narrow: DataFrame, sources: DataFrame) -> DataFrame:
    """Source columns and the block of each row; the source table has a row per source."""
    s = sources.withColumnRenamed("__src", "__name")
    out = narrow.join(F.broadcast(s), narrow["__src"].eqNullSafe(s["__name"])).drop("__name")
    return out.withColumn("__block", F.expr("__u div (4611686018427387904 div n_blocks + 1)"))


def draw(sized: DataFrame, plan: Mix, doc_id: str = "doc_id", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix: a row for every time that a document is taken, with all its columns and
    ``shard`` and ``place`` (its order in the shard), partitioned and sorted by them.

    Dealing blocks to shards is a join on (source, pass, block) whose other side has a
    row per block."""
    keep = [c for c in sized.columns if c not in ("shard", "place")]
    # the document's columns travel as one, so that none can clash with the plan's
    rows = sized.select(F.struct(*keep).alias("__row"), F.col(doc_id).alias("__doc"), F.col(source).alias("__src"), F.col("size").alias("__size"))
    rows = rows.withColumn("__u", _u(seed))
    rows = with_source(rows, plan.sources).join(F.broadcast(plan.edge), "source_rank", "left")
    # documents of the edge block up to the target; only these blocks are ordered
    narrow = rows.filter(F.col("__block") == F.col("__edge")).select("source_rank", "__u", "__size", "__room")
    upto = (narrow.groupBy("source_rank", "__u", "__room").agg(F.sum("__size").alias("__size"))
            .withColumn("upto", F.sum("__size").over(Window.partitionBy("source_rank").orderBy("__u"))))
    limit = upto.filter(F.col("upto") - F.col("__size") / 2 <= F.col("__room")).groupBy("source_rank").agg(F.max("__u").alias("__limit"))
    rows = rows.join(F.broadcast(limit), "source_rank", "left")
    at = lambda rep: _pass_order(F.col("n_blocks"), F.col("__block"), rep)
    rows = rows.withColumn("__rep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    edge_at = _pass_order(F.col("n_blocks"), F.col("__edge"), F.col("passes"))
    last = (F.col("__rep") == F.col("passes"))
    inside = F.col("__edge").isNotNull() & ((at(F.col("passes")) < edge_at) | (
        (F.col("__block") == F.col("__edge")) & (F.col("__u") <= F.col("__limit"))))
    rows = rows.filter(~last | F.coalesce(inside, F.lit(False)))
    rows = rows.withColumn("__seq", F.col("__rep") * F.col("n_blocks") + at(F.col("__rep")))
    dealt = plan.deal.select("shard", F.col("source_rank").alias("__sr"), F.explode(F.expr("sequence(low, high - 1)")).alias("__sq"))
    rows = rows.join(dealt, (F.col("source_rank") == F.col("__sr")) & (F.col("__seq") == F.col("__sq")))
    place = F.xxhash64(F.lit(seed + 1), F.col("shard"), F.col("__rep"), F.col("__u"))
    return rows.select("__row.*", "shard", place.alias("place")).repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")


def planned(docs: DataFrame, weights: Callable[[int], float] = cycle_weights, doc_id: str = "doc_id", source: str = "source", text: str = "text",
            seed: int = SEED, max_repeats: int = MAX_REPEATS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, Mix]:
    """The stored sizes (doc_id, source, size) of ``docs`` and the plan of their mix."""
    sized = stored(measured(docs.select(doc_id, source, text), doc_id, source, text).select(doc_id, source, "size"), "sizes")
    return sized, plan_mix(sized, weights, doc_id, source, seed, max_repeats, shard_words)


def mix_sources(docs: DataFrame, weights: Callable[[int], float] = cycle_weights, doc_id: str = "doc_id", source: str = "source",
                text: str = "text", seed: int = SEED, max_repeats: int = MAX_REPEATS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` mixed: its columns, ``shard`` and ``place`` (columns of these names are replaced)."""
    _, plan = planned(docs, weights, doc_id, source, text, seed, max_repeats, shard_words)
    own = F.struct(*[c for c in docs.columns if c not in ("shard", "place")]).alias("__own")
    sized = docs.select(own, F.col(doc_id).alias("__id"), F.col(source).alias("__from"), F.size(words(F.col(text))).cast("long").alias("size"))
    return draw(sized, plan, "__id", "__from", seed).select("__own.*", "shard", "place")
