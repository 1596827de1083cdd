"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every document's size (words) is counted once; the table of sizes carries no
   text. Sources share all words by weight; what a source would get above
   ``MAX_REPEATS`` times its size is shared again by the others.
2. A source's documents fall into blocks by a hash, and a modular permutation
   gives each block its place; no sort of a source is needed. A source whose
   target is ``e`` times its size and a rest takes all its blocks ``e`` times
   and the first places of its permutation for the rest. Where the rest ends is
   found from word sums of at most ``RANGES`` ranges of places per source, then
   within one range; the block it ends in gives those of its documents that
   still fit. So targets are met within a few words, with whole documents.
3. The exact block quotas are dealt to output shards by a binary tree: a node
   splits its quotas by one multivariate-hypergeometric draw. A shard owns one
   run of draws of each source, so draws are disjoint, and is shuffled locally.
4. A block's draws are looked up in those runs: each is a place in the order of
   its source (the permutation, repeated), owned by one shard or by none. What
   the mix takes of a document is the sum over the shards that own a draw of
   its block.

Only sums per source (and range), at most ``MAX_SHARDS`` shards and one ending
block per source meet the driver. Joins are on (source, block), so a source
with a third of all rows is spread over its blocks. Equal input gives equal
output, whatever the partitions.

Defined cases: null and empty texts have size 0 and are taken as often as
their block; null source is a source of its own and comes last; null and
repeated ids are fine (equal rows share one decision, each row is counted);
an empty table, or one without words, gives targets of 0; extra columns are
kept by ``mix`` and ignored by ``shares``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import land, packed, ship, table, unpacked

#: The weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Documents of a block, about.
BLOCK_DOCS = 256
RANGES = 1024
SHARD_WORDS = 20_000_000
MAX_SHARDS = 4096
#: Orders in which the last documents are tried.
ORDERS = 64
SEED = 20_240


def words_in(text: Column) -> Column:
    """Number of words of a text column; null counts as empty."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([len(t.split()) if t else 0 for t in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return count(text)


def targets(sizes: list[int], weights: list[int], limit: int = MAX_REPEATS) -> list[Fraction]:
    """Words each source gives: its share by weight, at most ``limit`` times its size, the excess shared again."""
    out: list[Fraction] = [Fraction(0)] * len(sizes)
    left, free = Fraction(sum(sizes)), set(range(len(sizes)))
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / weight > limit * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = Fraction(limit * sizes[i])
        left -= sum(out[i] for i in over)
        free -= over
    return out


def permutation(n: int, seed: int) -> tuple[int, int]:
    """(a, b) of the place ``(a * block + b) mod n``; ``a`` has no factor in common with ``n``."""
    rng = np.random.default_rng([SEED, seed, n])
    while math.gcd(a := int(rng.integers(1, n + 1)), n) != 1:
        pass
    return a, int(rng.integers(0, n))


def split_tree(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Draws of each source (columns) in each shard (rows); shards are of equal size within one draw."""
    rng = np.random.default_rng(seed)

    def split(quota: np.ndarray, n: int) -> list[np.ndarray]:
        if n == 1:
            return [quota]
        half, left, rest = n // 2, np.zeros_like(quota), quota.copy()
        want = int(quota.sum()) * half // n
        for k in range(len(quota)):  # one multivariate draw, source after source
            others = int(rest[k + 1 :].sum())
            left[k] = rng.hypergeometric(int(rest[k]), others, want) if want and rest[k] + others else 0
            want -= int(left[k])
        return split(left, half) + split(quota - left, n - half)

    return np.stack(split(np.array(quotas, np.int64), max(1, shards)))


class Mix:
    """The decisions over one table: per source its target, per block and document the repeats."""

    def __init__(self, docs: DataFrame, shard_words: int = SHARD_WORDS):
        spark = docs.sparkSession
        ship(spark)
        sizes = docs.select("doc_id", "source", F.xxhash64("text").alias("digest"), words_in(F.col("text")).alias("size"))
        sizes = land(sizes, "mix-sizes")
        found = sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows")).collect()
        found.sort(key=lambda r: (r.source is None, r.source or ""))
        self.names = [r.source for r in found]
        self.words = [int(r.words) for r in found]
        self.targets = targets(self.words, [WEIGHTS[k % len(WEIGHTS)] for k in range(len(found))])
        self.n_blocks = n_blocks = [max(1, math.ceil(r.rows / BLOCK_DOCS)) for r in found]
        self.epochs = [int(t // w) if w else 0 for t, w in zip(self.targets, self.words, strict=True)]
        rest = [int(round(t - e * w)) for t, e, w in zip(self.targets, self.epochs, self.words, strict=True)]
        perm = [permutation(n, k) for k, n in enumerate(n_blocks)]
        # One row a source: as small as the list of sources itself.
        self.sources = F.broadcast(spark.createDataFrame(
            [(k, s, n, a, b, e, w, float(t)) for k, (s, n, (a, b), e, w, t) in enumerate(zip(self.names, n_blocks, perm, self.epochs, self.words, self.targets, strict=True))],
            "src int, src_name string, n_blocks long, a long, b long, epochs int, source_size long, target double",
        ))
        rows = sizes.join(self.sources, F.col("source").eqNullSafe(F.col("src_name")))
        self.sizes = rows.select("doc_id", "digest", "size", "src", _block().alias("block"), "n_blocks", "a", "b", "epochs", "source_size", "target")
        place = F.pmod(F.col("a").cast("decimal(19,0)") * F.col("block") + F.col("b"), F.col("n_blocks")).cast("long")
        blocks = self.sizes.groupBy("src", "block", "n_blocks", "a", "b").agg(F.sum("size").alias("words"))
        blocks = blocks.select("src", "block", "words", place.alias("place"), F.floor(place * RANGES / F.col("n_blocks")).cast("int").alias("range"))
        self.blocks = land(blocks, "mix-blocks")
        self._end(rest)
        quotas = [e * n + f for e, n, f in zip(self.epochs, n_blocks, self.full, strict=True)]
        self.tree = split_tree(quotas, min(MAX_SHARDS, max(1, math.ceil(sum(self.words) / shard_words))))

    def _end(self, rest: list[int]) -> None:
        """Where each source's rest ends: whole blocks before it, and the documents of the block it ends in."""
        spark = self.blocks.sparkSession
        sums: dict[int, list] = {}
        for r in self.blocks.groupBy("src", "range").agg(F.sum("words").alias("words")).orderBy("src", "range").collect():
            sums.setdefault(r.src, []).append((r.range, int(r.words)))
        ends = []
        for k, want in enumerate(rest):
            before = 0
            for at, words in sums.get(k, []):
                if before + words > want:
                    ends.append((k, at, want - before))
                    break
                before += words
        schema = "src int, range int, want long"
        inside = self.blocks.join(F.broadcast(spark.createDataFrame(ends, schema)), ["src", "range"])
        so_far = F.sum("words").over(Window.partitionBy("src").orderBy("place"))
        inside = inside.withColumn("so_far", so_far).where("so_far > want")
        first = inside.groupBy("src").agg(F.min(F.struct("place", "block", "words", "so_far", "want")).alias("f")).select("src", "f.*").collect()
        at = {r.src: r for r in first}
        # Places before a source's end are whole blocks; a source that ends nowhere takes no rest or all of it.
        self.full = [int(at[k].place) if k in at else 0 for k in range(len(rest))]
        last = spark.createDataFrame(
            [(r.src, int(r.block), int(r.want - (r.so_far - r.words))) for r in first], "src int, block long, want long"
        )
        candidates = self.sizes.join(F.broadcast(last), ["src", "block"]).groupBy("src", "doc_id", "digest", "size", "want").agg(F.count("*").alias("n"))
        self.extra = land(candidates.groupBy("src").applyInPandas(_fitting, "src int, doc_id long, digest long"), "mix-extra")

    def drawn(self) -> DataFrame:
        """(src, block, shards) of every block: the shards that own its draws, in the order of the draws."""
        spark = self.blocks.sparkSession
        runs = np.cumsum(self.tree, axis=0)  # by shard, the draws of a source up to the end of its run
        rows = [(k, n, e, runs[:, k].tolist()) for k, (n, e) in enumerate(zip(self.n_blocks, self.epochs, strict=True))]
        blocks = self.blocks.join(F.broadcast(spark.createDataFrame(rows, "src int, n_blocks long, epochs int, ends array<long>")), "src")
        draws = F.transform(F.sequence(F.lit(0), F.col("epochs")), lambda e: e * F.col("n_blocks") + F.col("place"))
        owned = F.filter(draws, lambda d: d < F.element_at("ends", -1))
        shard = F.transform(owned, lambda d: F.size(F.filter("ends", lambda end: end <= d)))
        return blocks.select("src", "block", shard.alias("shards"))

    def repeats(self) -> DataFrame:
        """The sizes with ``shards`` (of whole blocks' draws) and ``extra`` (once more, in the last shard, from the ending block)."""
        rows = self.sizes.join(self.drawn(), ["src", "block"])
        picked = self.extra.select(F.col("src").alias("x_src"), F.col("doc_id").alias("x_id"), F.col("digest").alias("x_digest"), F.lit(1).alias("extra"))
        same = (F.col("src") == F.col("x_src")) & F.col("doc_id").eqNullSafe(F.col("x_id")) & (F.col("digest") == F.col("x_digest"))
        rows = rows.join(F.broadcast(picked), same, "left").withColumn("extra", F.coalesce("extra", F.lit(0)))  # the documents of one block a source
        last = F.array_repeat(F.lit(len(self.tree) - 1), F.col("extra"))
        return rows.withColumn("shards", F.concat("shards", last))


def _block() -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("digest")), F.col("n_blocks"))


def _fitting(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one ending block that fit best: first fit in each of ``ORDERS`` fixed random orders."""
    size, want = (rows["size"] * rows["n"]).to_numpy(), int(rows["want"].iloc[0])
    key = rows["digest"].to_numpy().view(np.uint64) ^ rows["doc_id"].fillna(-1).to_numpy().astype(np.int64).view(np.uint64)
    least, best = want + 1, np.zeros(len(rows), bool)
    for k in range(ORDERS):
        left, chosen = want, np.zeros(len(rows), bool)
        for i in np.argsort((key + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15), kind="stable").tolist():
            if 0 < size[i] <= left:
                chosen[i] = True
                left -= int(size[i])
        if left < least:
            least, best = left, chosen
    return rows[best][["src", "doc_id", "digest"]]


def shares(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken and n_shards (the shards it is in) of every row (doc_id, text, source)."""
    rows = Mix(docs, shard_words).repeats()
    taken = F.col("size") * F.size("shards")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.size(F.array_distinct("shards")).alias("n_shards"))


def mix(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` repeated as the mix takes them, in shards (one or more partitions each) that are shuffled locally."""
    made = Mix(docs, shard_words)
    taken = made.repeats().where(F.size("shards") > 0).join(made.sources.select(F.col("src").alias("k"), "src_name"), F.col("src") == F.col("k"))
    taken = taken.select(F.col("doc_id").alias("t_id"), F.col("digest").alias("t_digest"), F.col("src_name").alias("t_source"), "shards").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.xxhash64(F.col("row").getField("text")) == F.col("t_digest")) & F.col("host").eqNullSafe(F.col("t_source"))
    rows = packed(docs, "source").join(taken, same).select("row", "t_id", "t_digest", F.posexplode("shards").alias("draw", "shard"))
    rows = rows.withColumn("order", F.xxhash64(F.lit(SEED), "t_id", "t_digest", "draw"))
    return unpacked(rows.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order"), docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return shares(table(spark, sf_dir, "documents"))
