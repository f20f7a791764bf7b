"""Mixing sources to target shares of all tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasemill.session import materialize

MOST_SOURCES = 10_000


@dataclass(frozen=True)
class Quota:
    """What one source gives: its tokens, its share of them in the mixture, the blocks these are cut into."""

    source: str
    target: float
    repeats: int
    available: int
    tokens: int
    blocks: int


class SplittingTree:
    """The blocks of each source that each output shard gets.

    The root holds all blocks of all sources and all shards. A node with several shards halves
    these, and the blocks of the left half are drawn from the node's without replacement, that is by
    one draw of the multivariate hypergeometric distribution; the right half gets the rest. So the
    leaves together hold every block exactly once, and each is a random sample of the whole. A
    node's draw is seeded by its place, so any leaf can be found alone, on any executor.
    """

    def __init__(self, blocks: Sequence[int], shards: int, seed: int):
        self.blocks, self.shards, self.seed = tuple(int(b) for b in blocks), shards, seed
        self._node = lru_cache(maxsize=4096)(self._held)

    def _held(self, lo: int, hi: int, parent: tuple[int, int] | None) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """The blocks of each source that the node holds, and how many of each lie left of it."""
        if parent is None:
            return self.blocks, (0,) * len(self.blocks)
        plo, phi = parent
        above, before = self._node(plo, phi, self._parent(plo, phi))
        middle = (plo + phi) // 2
        rng = np.random.default_rng([self.seed, plo, phi])
        left = draw_colours(rng, above, sum(above) * (middle - plo) // (phi - plo))
        if (lo, hi) == (plo, middle):
            return tuple(left), before
        return tuple(a - x for a, x in zip(above, left, strict=True)), tuple(b + x for b, x in zip(before, left, strict=True))

    def _parent(self, lo: int, hi: int) -> tuple[int, int] | None:
        a, b, parent = 0, self.shards, None
        while (a, b) != (lo, hi):
            parent, m = (a, b), (a + b) // 2
            a, b = (a, m) if hi <= m else (m, b)
        return parent

    def leaf(self, shard: int) -> tuple[int, ...]:
        return self.placed(shard)[0]

    def placed(self, shard: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """A shard's blocks of each source, and the place of the first among the source's permuted blocks."""
        return self._node(shard, shard + 1, self._parent(shard, shard + 1))


NUMPY_MOST = 10**9  # numpy draws from fewer than so many


def draw_colours(rng: np.random.Generator, colours: Sequence[int], take: int) -> list[int]:
    """``take`` items drawn without replacement, by colour: one draw of the multivariate hypergeometric distribution, whatever its size."""
    total = sum(colours)
    if 0 < total < NUMPY_MOST:
        return [int(x) for x in rng.multivariate_hypergeometric(colours, take, method="marginals")]
    out = []
    for c in colours:
        total -= c
        out.append(draw_good(rng, c, total, take))
        take -= out[-1]
    return out


def draw_good(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """One draw of the hypergeometric distribution, of any size.

    Beyond what numpy draws, by inversion: the probabilities around the mode follow from the ratios of
    neighbours, each to full precision; what lies over 12 deviations off has less than 1e-31.
    """
    total = good + bad
    low, high = max(0, take - bad), min(good, take)
    if low == high:
        return low
    if total < NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, take))
    mode = (take + 1) * (good + 1) // (total + 2)
    share = good / total
    reach = int(12 * math.sqrt(take * share * (1 - share) * (total - take) / (total - 1))) + 12
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=float)
    ratios = np.log(good - k) + np.log(take - k) - np.log(k + 1) - np.log(float(bad - take) + k + 1)
    logs = np.append(0.0, np.cumsum(ratios))
    chance = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(chance, rng.random() * chance[-1], "right"))


def plan_quotas(targets: Sequence[tuple[str, float, int]], available: dict[str, int], block_tokens: int, total_tokens: int | None = None) -> list[Quota]:
    """The tokens of each source for the largest mixture that keeps all shares and no repeat above its cap.

    Sources without tokens can give none; the others' shares are scaled up to sum to 1. A smaller
    ``total_tokens`` may be asked for; a larger one is cut to what the caps allow.
    """
    usable = [(s, t, r) for s, t, r in targets if s is not None and t > 0 and r > 0 and available.get(s, 0) > 0]
    whole = sum(t for _, t, _ in usable)
    most = min((r * available[s] * whole / t for s, t, r in usable), default=0.0)
    total = most if total_tokens is None else min(most, float(total_tokens))
    quotas = []
    for s, t, r in targets:
        own = available.get(s, 0)
        tokens = min(r * own, math.floor(total * t / whole + 0.5)) if (s, t, r) in usable else 0
        quotas.append(Quota(s, t, r, own, tokens, -(-tokens // block_tokens)))
    return quotas


def _step(blocks: int, seed: int) -> tuple[int, int]:
    """Multiplier and offset of a seeded permutation of ``range(blocks)``."""
    rng = np.random.default_rng([seed, blocks])
    if blocks < 2:
        return 1, 0
    while True:
        a = int(rng.integers(1, min(blocks, 1 << 31)))
        if math.gcd(a, blocks) == 1:
            return a, int(rng.integers(0, blocks))


def mix_sources(sizes: DataFrame, doc: str, source: str, size: str, targets: DataFrame, shard_tokens: int = 1 << 18, block_tokens: int = 1 << 13, total_tokens: int | None = None, seed: int = 17, buckets: int = 1 << 12) -> tuple[DataFrame, DataFrame]:
    """``(mixture, shares)`` of documents whose ``size`` is given in tokens.

    ``targets`` has source, target_share, max_repeats. The mixture has one row per use of a document:
    ``(shard, position, doc, source, copy, n_tokens)``. A document is used ``max_repeats`` times at
    most, and copy 1 of any only after copy 0 of all of its source. shares has one row per target:
    ``(source, target_share, max_repeats, available_tokens, used_tokens, share, n_uses, n_docs,
    most_uses)``; a source with a target but no tokens has share 0.

    The documents of a source are put in a random order (by a hash, so hot sources spread over
    ``buckets``) and laid end to end, as often as the source's quota asks; what lies in the quota is
    used, to half a document. That line is cut into blocks of ``block_tokens``, the blocks are
    permuted, and a :class:`SplittingTree` gives each output shard its number of blocks of each
    source: disjoint runs of permuted blocks. Rows are then shuffled within their shard. No task
    holds more than a bucket of a source or a shard; to the driver come one row per target.

    Documents of other sources, of NULL source or id, or without tokens stay out. Rows of one id
    count as one document (the least by source and size). Empty tables give no rows, and shares of 0.
    """
    wanted = targets.select("source", "target_share", "max_repeats").filter(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("t"), F.max("max_repeats").alias("r")).limit(MOST_SOURCES + 1).collect()
    if len(wanted) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} targets")
    plan = sorted((w["source"], float(w["t"] or 0), int(w["r"] or 0)) for w in wanted)
    names = [s for s, _, _ in plan]
    docs = sizes.select(F.col(doc).alias("doc"), F.col(source).alias("source"), F.col(size).cast("long").alias("n")).filter(F.col("doc").isNotNull() & F.col("source").isin(names) & (F.col("n") > 0))
    docs = docs.groupBy("doc").agg(F.min(F.struct("source", "n")).alias("d")).select("doc", "d.*").withColumn("h", F.xxhash64("doc", F.lit(seed))).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 16), F.lit(buckets)))
    docs = materialize(docs, "mix-sizes")

    per = docs.groupBy("source", "bucket").agg(F.sum("n").alias("tokens"))
    available = {r["source"]: r["tokens"] for r in per.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    quotas = plan_quotas(plan, available, block_tokens, total_tokens)
    total = sum(q.tokens for q in quotas)
    shards = max(1, -(-total // shard_tokens))
    given = _rows(docs.sparkSession, quotas, seed)

    before = per.withColumn("before", F.coalesce(F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("tokens")
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("source", "bucket").orderBy("h", "doc").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per target, so a broadcast of a size bounded by MOST_SOURCES
    placed = docs.withColumn("inside", inside).join(before, ["source", "bucket"]).join(F.broadcast(given), "source").withColumn("at", F.col("before") + F.col("inside"))
    copies = F.floor((F.col("quota") - F.col("at") - F.col("n") / 2) / F.col("available")) + 1
    uses = placed.withColumn("copies", F.least(copies, F.col("repeats"))).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    block = F.floor((F.col("at") + F.col("copy") * F.col("available")) / block_tokens)
    uses = uses.select("doc", "source", "copy", "n", F.pmod(block * F.col("a") + F.col("b"), F.col("blocks")).alias("block"))

    tree = SplittingTree([q.blocks for q in quotas], shards, seed)
    leaves = _leaves(docs.sparkSession, tree, names)
    owned = leaves.select("source", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("block"))
    mixed = uses.join(owned, ["source", "block"])
    order = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("doc", "copy", F.lit(seed + 1)), "doc", "copy")) - 1
    mixture = mixed.select("shard", order.cast("long").alias("position"), F.col("doc").alias(doc), "source", "copy", F.col("n").alias("n_tokens"))

    used = uses.groupBy("source", "doc").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("k")).groupBy("source").agg(F.sum("tokens").alias("used_tokens"), F.sum("k").alias("n_uses"), F.count(F.lit(1)).alias("n_docs"), F.max("k").alias("most_uses"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    all_tokens = F.sum("used_tokens").over(Window.partitionBy(F.lit(1)))
    shares = given.join(used, "source", "left").withColumn("used_tokens", zero("used_tokens"))
    shares = shares.select("source", F.col("target").alias("target_share"), F.col("repeats").alias("max_repeats"), F.col("available").alias("available_tokens"), "used_tokens", F.coalesce(F.try_divide("used_tokens", all_tokens), F.lit(0.0)).alias("share"), zero("n_uses"), zero("n_docs"), zero("most_uses"))
    return mixture, shares


def _rows(spark, quotas: list[Quota], seed: int) -> DataFrame:
    rows = [(q.source, q.target, q.repeats, q.available, q.tokens, q.blocks, *_step(q.blocks, seed + i)) for i, q in enumerate(quotas)]
    return spark.createDataFrame(rows, "source string, target double, repeats long, available long, quota long, blocks long, a long, b long")


def _leaves(spark, tree: SplittingTree, names: list[str]) -> DataFrame:
    """``(source, shard, first, blocks)`` of what shards hold, found on the executors, each task a range of shards."""
    blocks, shards, seed = tree.blocks, tree.shards, tree.seed

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, sources = SplittingTree(blocks, shards, seed), np.array(names, dtype=object)
        for b in batches:
            placed = np.array([own.placed(int(i)) for i in b["id"]], dtype=np.int64).reshape(len(b), 2, len(names))
            row, source = np.nonzero(placed[:, 0])
            yield pd.DataFrame({"source": sources[source], "shard": b["id"].to_numpy()[row], "first": placed[row, 1, source], "blocks": placed[row, 0, source]})

    return spark.range(shards).mapInPandas(run, "source string, shard long, first long, blocks long")
