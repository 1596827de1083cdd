"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then the exact bit distance.

Each text's fingerprint is made where the text is read. Only distinct
fingerprints (8 bytes) are compared, so copies never meet each other. The 64
bits are cut into ``n`` blocks; fingerprints that differ in at most ``d`` bits
agree on at least ``n - d`` whole blocks, so every choice of ``n - d`` blocks
is one table of join keys, and close pairs share a key in one of them. ``n``
grows with the number of distinct fingerprints (longer keys, more tables) so
that buckets stay small; each choice finds the same links.

Buckets are compared inside the tasks they are dealt to, and each gives the
links of a spanning forest, not all its pairs: what is linked stays linked.
Buckets of over ``TILE`` fingerprints are first cut into tiles of at most about
two chunks, which together still compare every pair of the bucket; so no task
gathers a bucket without bound.

Defined cases: null and empty texts, and texts of white space, have
fingerprint zero and link like any other; repeated rows and repeated ids each
keep a row; a null id stays null and never names a component (a component
without any id has a null id); an empty table gives an empty table; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import identified, land, packed, ship, table, unpacked
from .components import components

SEED = 42
#: Fingerprints compared with each other at most, as one chunk of a bucket.
TILE = 2048
#: Mean number of chance bucket mates up to which a block scheme is used.
CHANCE_MATES = 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LANES = np.uint64(0x0101010101010101)


def fingerprint_of(text: str, shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle:
        return hash64(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    spans = zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([hash64(joined[a:z], SEED) for a, z in spans], np.uint64)
    cuts, bits = np.arange(0, len(hashes), 255), 0
    for k in range(8):  # bit k of every byte at once; 255 hashes can't overflow a byte's count
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, cuts).astype("<u8").view(np.uint8)
        for byte, n in enumerate(lanes.reshape(-1, 8).sum(axis=0, dtype=np.int64)):
            if 2 * n > len(hashes):
                bits |= 1 << (8 * byte + k)
    return bits


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """Fingerprints of a text column, as signed longs; null counts as empty."""

    @F.arrow_udf("long")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.array([fingerprint_of(t or "", shingle) for t in texts.to_pylist()], np.uint64)
            yield pa.array(found.view(np.int64))

    return fingerprints(text)


def block_masks(n_fingerprints: int, max_bits: int) -> list[int]:
    """Masks of the block choices: the fewest blocks whose keys leave few chance mates; two blocks at least make a key."""
    for blocks in range(max_bits + 2, 65):
        agree = blocks - max_bits
        shortest = agree * (64 // blocks)
        if n_fingerprints / 2.0**shortest <= CHANCE_MATES or math.comb(blocks, agree) > 60:
            break
    edges = [64 * k // blocks for k in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, agree)]


def _forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph of values within ``max_bits``."""
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(len(values) - 1):
        for j in (np.nonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= max_bits)[0] + i + 1).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                links.append((i, j))
    return links


def _bucket_links(max_bits: int):
    """Streams a partition's rows, sorted by bucket, and links each bucket's fingerprints."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the rows of the bucket that the next batch may continue
        for batch in _ended(batches):
            if batch is not None:
                rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], axis=1)
                if len(rows):
                    held.append(rows)
                if not len(rows) or (held[0][0, :3] == rows[-1, :3]).all():
                    continue
            if not held:
                continue
            rows = np.concatenate(held)
            cut = np.nonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1))[0] + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(rows)]))
            held = []
            if batch is not None:
                held, starts, ends = [rows[starts[-1] :]], starts[:-1], ends[:-1]
            fps, a, b = rows[:, 3].view(np.uint64), [], []
            size = ends - starts
            two = starts[size == 2]
            close = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits] if len(two) else two
            a.append(fps[close])
            b.append(fps[close + 1])
            for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist(), strict=True):
                if links := _forest(fps[s:e], max_bits):
                    pairs = np.array(links)
                    a.append(fps[s:e][pairs[:, 0]])
                    b.append(fps[s:e][pairs[:, 1]])
            yield pa.record_batch({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    return compare


def _ended(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: each linked pair is connected by them."""
    masks = block_masks(fps.count(), max_bits)
    keyed = fps.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks])).alias("block", "key")
    )
    hot = keyed.groupBy("block", "key").count().where(F.col("count") > TILE)
    hot = hot.select("block", "key", F.ceil(F.col("count") / TILE).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    mates = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.least(k, F.col("chunk")) * F.col("chunks") + F.greatest(k, F.col("chunk")))
    tiled = keyed.join(hot, ["block", "key"], "left").withColumn("chunk", F.when(F.col("chunks").isNotNull(), chunk))
    dealt = tiled.select("block", "key", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(mates)).alias("tile"), "fp")
    dealt = dealt.select(F.col("block").cast("long"), "key", F.col("tile").cast("long"), "fp")
    dealt = dealt.repartition("block", "key", "tile").sortWithinPartitions("block", "key", "tile")
    return dealt.mapInArrow(_bucket_links(max_bits), "a long, b long")


def classes(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row: the least id reachable over links."""
    ship(docs.sparkSession)
    rows = land(identified(docs, id_col, text_col).select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    fps = land(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    roots = components(land(links(fps.select("fp"), max_bits), "simhash-links"))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    return rows.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each component, the one with the least id.

    Rows without an id have no place in that order and stay. Of rows that
    repeat the least id one stays (the least by a hash of all its columns).
    """
    chosen = classes(docs, shingle, max_bits).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = packed(docs)
    kept = rows.join(chosen, F.col("doc_id") == F.col("kept_id"))
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("row"))
    kept = kept.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return unpacked(kept.select("row").unionByName(rows.where("doc_id IS NULL").select("row")), docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, 4 bits)."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
