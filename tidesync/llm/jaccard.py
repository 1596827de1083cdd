"""N-gram Jaccard join: prefix filters under several token orders, intersected before pairs are verified.

A document's set is its distinct word shingles, as 64-bit hashes; documents
with equal sets are one node. Two sets that link share a token among the first
tokens (the prefix) of both under *every* global order of the tokens:

1. Order of hashes, with a prefix that is longer by ``EXTRA`` percent of the
   set, so that linked sets share that many tokens there, not only one. Sets
   too few of whose prefix tokens are in another set's prefix are out. Only
   this filter sees all sets; tokens travel packed, 16 bytes each.
2. Order of rarity among the sets left, rarest first, tokens of one set alone
   before all others: sets meet in the lists of their prefix tokens. Lists of
   the same sets are one list.
3. Two more orders of hashes (tokens of one set alone again first): a pair that
   met must share prefix tokens there too. Beside that its sizes, and counts of
   its tokens by 256 classes, must allow the overlap asked for.

Pairs that pass are verified by the exact intersection of their sets. Only
components are wanted, so each set is first tried with the most typical set of
its longest list; pairs that these links connect already are not tried again,
and a group of near copies is settled by about one trial for each of its sets.
Lists of over ``TILE`` sets are compared in tiles, which together hold every
pair not yet connected; no list is gathered in one task.

Memory of a task is bounded by one range of tokens (``RANGE``) plus one entry
for each flush and hot token, by one tile, or by one document. A group of n
distinct texts that share rare passages but do not link costs comparisons of
256 byte counts in the square of n, spread over tiles.

Shingles and sets are told apart by 64-bit hashes: sets of 10^9 documents hold
an equal pair by chance at odds of about one in 40.

Defined cases: null and empty texts and texts of white space have the empty
set, size 0 and link with nothing (their component is their own id); repeated
rows and repeated ids each keep a row; a null id stays null and never names a
component (a component without any id has a null id); an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identified, land, ship, table
from .components import components

SHINGLE, PERCENT = 5, 80
#: Percent of a set by which its prefix in the first order is longer than one shared token needs.
EXTRA = 10
#: Token entries of a range, about, and those a task holds before it hands them on.
RANGE, HAND_ON = 250_000, 1_000_000
#: Digests a task remembers, so that it sends the tokens of a set once.
REMEMBERED = 200_000
#: Sets compared with each other at most, as one side of a tile.
TILE = 2048
CLASSES = 256
#: Words of one block of a text, and bytes from which a word is replaced by its hash.
BLOCK_WORDS, LONG_WORD = 8192, 256

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BASE = 0x9E3779B97F4A7C15
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTES = np.frombuffer(b"".join(xxhash.xxh3_64_digest(bytes([b])) for b in range(256)), np.uint64)
_POWER = {"up": _powers(_BASE, 1 << 14), "down": _powers(pow(_BASE, -1, 1 << 64), 1 << 14)}


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """An independent order of the same tokens for every ``salt``."""
    h = h ^ np.uint64(salt * _BASE % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


def _window_hashes(joined: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte runs ``start`` to ``end``: a polynomial in the bytes that doesn't depend on the place."""
    if len(joined) > len(_POWER["up"]):
        size = 1 << (len(joined) - 1).bit_length()
        _POWER["up"], _POWER["down"] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTES[joined] * _POWER["up"][: len(joined)], out=sums[1:])
    return (sums[end] - sums[start]) * _POWER["down"][start]


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as ascending hashes (unsigned)."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.append(np.flatnonzero(joined == 32), len(joined))
    starts = np.append(0, ends[:-1] + 1)
    if int((ends - starts).max()) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"\0" + xxhash.xxh3_128_hexdigest(w).encode() for w in words]
        joined = np.frombuffer(b" ".join(words), np.uint8)
        ends = np.append(np.flatnonzero(joined == 32), len(joined))
        starts = np.append(0, ends[:-1] + 1)
    k = min(shingle, len(words))
    found = []
    for a in range(0, len(words) - k + 1, BLOCK_WORDS):
        z = min(len(words) - k + 1, a + BLOCK_WORDS)
        first = starts[a]
        found.append(_window_hashes(joined[first : ends[z + k - 2]], starts[a:z] - first, ends[a + k - 1 : z + k - 1] - first))
    return np.unique(mixed(np.concatenate(found)))


def least_overlap(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Tokens of a set of ``n`` that any set linked with it has too, at least."""
    return -(-percent * n // 100)


def long_prefix(n: int, percent: int) -> int:
    """Tokens of the longer prefix in the first order."""
    return n - least_overlap(n, percent) + -(-EXTRA * n // 100)


def _profiles(shingle: int, percent: int):
    """(doc_id, raw, n, digest, prefix): the prefix only once a task and set."""

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for at in range(0, batch.num_rows, 1000):
                sizes, digests, prefixes = [], [], []
                for text in texts.slice(at, 1000).to_pylist():
                    tokens = shingle_set(text, shingle)
                    digest = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())))) if len(tokens) else None
                    sizes.append(len(tokens))
                    digests.append(digest)
                    fresh = digest is not None and digest not in seen
                    prefixes.append(tokens[: long_prefix(len(tokens), percent)].tobytes() if fresh else None)
                    if fresh:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(digest)
                part = batch.slice(at, 1000)
                columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.int64()), pa.array(prefixes, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "raw", "n", "digest", "prefix"])

    return profiles


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the runs of equal values."""
    starts = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(sorted_values)))


def _spread(ranges: int):
    """Prefix tokens by ranges. Tokens that a task meets in several sets go on once, marked; their sets are counted at once."""

    def handed(tokens: list[np.ndarray], owners: list[int]) -> Iterator[pa.RecordBatch]:
        flat, own = np.concatenate(tokens), np.repeat(np.array(owners, np.int64), [len(t) for t in tokens])
        order = np.argsort(flat, kind="stable")
        flat, own = flat[order], own[order]
        start, size = _runs(flat)
        known, hits = np.unique(own[np.repeat(size, size) > 1], return_counts=True)
        token, owner, alone = flat[start], own[start], size == 1
        part = (mixed(token, 7) % np.uint64(ranges)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, token, owner, alone = part[order], token[order], owner[order], alone[order].astype(np.uint8)
        start, size = _runs(part)
        rows = [(int(part[a]), token[a : a + s].tobytes(), owner[a : a + s].tobytes(), alone[a : a + s].tobytes()) for a, s in zip(start.tolist(), size.tolist(), strict=True)]
        rows.append((int(part[0]), b"", known.tobytes(), hits.astype(np.int64).tobytes()))
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["part", "tokens", "owners", "marks"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, held = [], [], 0
        for batch in batches:
            for digest, prefix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens.append(np.frombuffer(prefix, np.uint64))
                owners.append(digest)
                held += len(tokens[-1])
                if held >= HAND_ON:
                    yield from handed(tokens, owners)
                    tokens, owners, held = [], [], 0
        if held:
            yield from handed(tokens, owners)

    return spread


def _shared(rows: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(digests, hits) of one range: how many of a set's prefix tokens there are in other sets' prefixes."""
    plain = [r for r in rows if r[0]]
    token, owner, alone = (np.concatenate([np.frombuffer(r[k], t) for r in plain]) if plain else np.zeros(0, t) for k, t in enumerate((np.uint64, np.int64, np.uint8)))
    order = np.lexsort((alone, owner, token))
    token, owner, alone = token[order], owner[order], alone[order]
    again = np.append(False, (token[1:] == token[:-1]) & (owner[1:] == owner[:-1]) & (alone[1:] == 1) & (alone[:-1] == 1))[: len(token)]
    token, owner, alone = token[~again], owner[~again], alone[~again]
    start, size = _runs(token)
    marked = np.minimum.reduceat(alone, start) == 0 if len(start) else np.zeros(0, bool)
    found = [(owner[np.repeat((size > 1) | marked, size) & (alone == 1)], None)]
    found += [(np.frombuffer(r[1], np.int64), np.frombuffer(r[2], np.int64)) for r in rows if not r[0]]
    return _added(found)


def _added(found: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray]:
    """Digests with the sums of their hits (None: one each)."""
    digest = np.concatenate([d for d, _ in found])
    hits = np.concatenate([np.ones(len(d), np.int64) if h is None else h for d, h in found])
    own, at = np.unique(digest, return_inverse=True)
    return own, np.bincount(at, weights=hits, minlength=len(own)).astype(np.int64)


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each value of the first column, which they are sorted by, without it."""
    key, rows = None, []
    for batch in batches:
        for k, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if k != key and rows:
                yield rows
                rows = []
            key = k
            rows.append(tuple(row))
    if rows:
        yield rows


def _hits(ranges: int):
    """Hits of the ranges of a task, summed and packed by ranges of digests."""

    def handed(found: list) -> pa.RecordBatch:
        digest, hits = _added(found)
        part = (mixed(digest.view(np.uint64), 8) % np.uint64(ranges)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, digest, hits = part[order], digest[order], hits[order]
        spans = [(a, a + n) for a, n in zip(*(x.tolist() for x in _runs(part)), strict=True)]
        return pa.record_batch({
            "part": pa.array([int(part[a]) for a, _ in spans], pa.int32()),
            "digests": pa.array([digest[a:z].tobytes() for a, z in spans], pa.binary()),
            "hits": pa.array([hits[a:z].tobytes() for a, z in spans], pa.binary()),
        })

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for rows in _by_key(batches):
            found.append(_shared(rows))
            if sum(len(d) for d, _ in found) >= HAND_ON:
                yield handed(found)
                found = []
        if found:
            yield handed(found)

    return counted


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, hits) of every set, once."""
    for rows in _by_key(batches):
        digest, hits = _added([(np.frombuffer(d, np.int64), np.frombuffer(h, np.int64)) for d, h in rows])
        yield pa.record_batch({"digest": digest, "hits": hits})


def _sets(shingle: int):
    """(digest, n, tokens) of texts, once a task and set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for at in range(0, batch.num_rows, 1000):
                rows = []
                for text in texts.slice(at, 1000).to_pylist():
                    tokens = shingle_set(text, shingle)
                    digest = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes()))))
                    if digest not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(digest)
                        rows.append((digest, len(tokens), tokens.view(np.int64)))
                if rows:
                    yield pa.record_batch({"digest": pa.array([r[0] for r in rows], pa.int64()), "n": pa.array([r[1] for r in rows], pa.int64()), "tokens": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})

    return sets


def _orders(percent: int):
    """(digest, n, shared tokens with their frequency) -> what the other orders need, for sets whose prefix has a shared token."""

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            shared = batch.column(2)
            flat, offset = shared.flatten(), np.append(0, np.cumsum(shared.value_lengths().to_numpy(zero_copy_only=False)))
            times, tokens = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            tokens = tokens.view(np.uint64)
            rows = []
            for digest, n, a, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), offset[:-1].tolist(), offset[1:].tolist(), strict=True):
                length = n - least_overlap(n, percent) + 1 - (n - (z - a))  # of the prefix, without the tokens of this set alone
                if length < 1:
                    continue
                own = np.sort(tokens[a:z])
                rare = tokens[a:z][np.lexsort((tokens[a:z], times[a:z]))][:length]
                others = [own[np.argsort(mixed(own, salt))[:length]] for salt in (1, 2)]
                counts = np.minimum(np.bincount((mixed(own, 3) % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES), 255).astype(np.uint8)
                rows.append((digest, n, n - (z - a), own.view(np.int64), rare.view(np.int64), *[x.view(np.int64) for x in others], counts.tobytes()))
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), longs, longs, longs, longs, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["digest", "n", "alone", "tokens", "rare", "second", "third", "counts"])

    return orders


def _compare(percent: int):
    """Streams tiles of lists and gives their pairs that pass all filters, each from one of its lists only."""

    def pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        this = rows[0][0]
        root, n, m = (np.array([r[k] for r in rows]) for k in (4, 5, 6))
        side = np.array([r[2] for r in rows])
        counts = np.frombuffer(b"".join(r[10] for r in rows), np.uint8).reshape(len(rows), CLASSES)
        second, third = ([frozenset(r[k]) for r in rows] for k in (7, 8))
        lists = [frozenset(r[9]) for r in rows]
        for i in range(len(rows) - 1):
            j = np.flatnonzero((root[i + 1 :] != root[i]) & (side[i + 1 :] + side[i] != 2)) + i + 1
            j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
            for at in range(0, len(j), TILE):
                k = j[at : at + TILE]
                apart = (np.maximum(counts[k], counts[i]) - np.minimum(counts[k], counts[i])).sum(axis=1, dtype=np.int64)
                for x in k[(100 + percent) * (m[k] + m[i] - apart) >= 2 * percent * (n[k] + n[i])].tolist():
                    if not second[i].isdisjoint(second[x]) and not third[i].isdisjoint(third[x]) and min(lists[i] & lists[x]) == this:
                        yield rows[i][3], rows[x][3]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if len(rows) > 1 and (found := list(pairs(rows))):
                a, b = np.array(found, np.int64).T
                yield pa.record_batch({"a": a, "b": b})

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(11)), strict=True):
                if held and held[0][:2] != row[:2]:
                    yield from given(held)
                    held = []
                held.append(row)
        yield from given(held)

    return compare


def _tiles(members: DataFrame) -> DataFrame:
    """Members (list, digest, root) of lists with several roots, dealt to tiles.

    A list's largest root is its main side; its members meet all others, the
    others also each other. ``side``: 1 main, 0 others, -1 in a tile of others
    alone or of a whole small list, where all pairs with different roots count.
    """
    by_root = members.groupBy("list", "root").agg(F.count("*").alias("rows"))
    lists = by_root.groupBy("list").agg(F.max(F.struct("rows", "root")).alias("main"), F.sum("rows").alias("rows"), F.count("*").alias("roots")).where("roots > 1")
    lists = lists.select("list", F.col("main.root").alias("main"), F.col("rows").alias("all"), F.ceil(F.col("main.rows") / TILE).cast("int").alias("mains"), F.ceil((F.col("rows") - F.col("main.rows")) / TILE).cast("int").alias("others"))
    rows = members.join(lists, "list")
    slot = lambda n: F.pmod(F.xxhash64("digest"), F.col(n)).cast("int")
    rows = rows.withColumn("is_main", F.col("root") == F.col("main")).withColumn("slot", F.when(F.col("is_main"), slot("mains")).otherwise(slot("others")))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tile = lambda number, side: F.struct(number.cast("long").alias("tile"), F.lit(side).alias("side"))
    main = F.transform(upto("others"), lambda k: tile(F.col("slot") * F.col("others") + k, 1))
    across = F.transform(upto("mains"), lambda k: tile(k * F.col("others") + F.col("slot"), 0))
    among = F.transform(upto("others"), lambda k: tile(F.col("mains") * F.col("others") + F.least(k, F.col("slot")) * F.col("others") + F.greatest(k, F.col("slot")), -1))
    dealt = F.when(F.col("all") <= TILE, F.array(tile(F.lit(0), -1))).when(F.col("is_main"), main).otherwise(F.concat(across, among))
    return rows.select("list", "digest", "root", F.explode(dealt).alias("t")).select("list", "t.tile", "t.side", "digest", "root")


def _verified(pairs: DataFrame, live: DataFrame, percent: int) -> DataFrame:
    """Links (a, b): the pairs whose sets overlap enough."""
    side = lambda name: live.select(F.col("digest").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"tokens_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")


def _alive(profiles: DataFrame, percent: int) -> DataFrame:
    """digest and one raw text hash of the sets that the first order leaves."""
    sets = profiles.where("n > 0")
    ranges = sets.agg(F.sum(F.octet_length("prefix"))).first()[0]
    ranges = max(1, math.ceil((ranges or 0) / 8 / RANGE))
    parts = sets.where("prefix IS NOT NULL").select("digest", "prefix").mapInArrow(_spread(ranges), "part int, tokens binary, owners binary, marks binary")
    hits = parts.repartition("part").sortWithinPartitions("part").mapInArrow(_hits(ranges), "part int, digests binary, hits binary")
    hits = hits.repartition("part").sortWithinPartitions("part").mapInArrow(_summed, "digest long, hits long")
    need = F.expr(f"({EXTRA} * (({percent} * n + 99) div 100) + 99) div 100")
    one = sets.groupBy("digest").agg(F.min("raw").alias("raw"), F.min("n").alias("n"))
    return land(one.join(hits, "digest").where(F.col("hits") >= need).select("raw"), "jaccard-alive")


def links(docs: DataFrame, profiles: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between set digests; what is linked by the sets is connected by them."""
    raws = _alive(profiles, percent).distinct()
    # The same plan at every size: texts are shuffled once, never behind a broadcast that depends on the number of sets left.
    texts = docs.select("raw", "text").join(raws.hint("merge"), "raw", "left_semi").select("text")
    alive = texts.mapInArrow(_sets(shingle), "digest long, n long, tokens array<long>")
    alive = land(alive.groupBy("digest").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "jaccard-sets")
    entries = alive.select("digest", F.explode("tokens").alias("token"))
    times = entries.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
    shared = entries.join(times, "token").groupBy("digest").agg(F.collect_list(F.struct("times", "token")).alias("shared"))
    live = alive.select("digest", "n").join(shared, "digest").mapInArrow(
        _orders(percent), "digest long, n long, alone long, tokens array<long>, rare array<long>, second array<long>, third array<long>, counts binary")
    live = land(live, "jaccard-live")

    rows = live.select("digest", (F.col("alone") / F.col("n")).alias("rest"), F.explode("rare").alias("list"))
    lists = rows.groupBy("list").agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("y"), F.min(F.struct("rest", "digest")).alias("pivot"))
    lists = lists.where("rows > 1").groupBy("rows", "x", "y").agg(F.min(F.struct("list", "pivot.digest")).alias("l"))
    lists = lists.select("l.list", "rows", F.col("l.digest").alias("pivot"))
    members = land(rows.select("list", "digest").join(lists, "list"), "jaccard-members")

    first = members.where("digest <> pivot").groupBy("digest").agg(F.max(F.struct("rows", "pivot")).alias("p"))
    found = land(_verified(first.select(F.col("digest").alias("a"), F.col("p.pivot").alias("b")), live, percent), "jaccard-links")
    roots = components(found)
    named = members.select("list", "digest").join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    tiles = land(_tiles(named), "jaccard-tiles")
    own = tiles.select("digest", "list").distinct().groupBy("digest").agg(F.collect_list("list").alias("lists"))
    about = live.select("digest", "n", F.size("tokens").cast("long").alias("m"), "second", "third", "counts").join(own, "digest")
    dealt = tiles.join(about, "digest").select("list", "tile", "side", "digest", "root", "n", "m", "second", "third", "lists", "counts")
    dealt = dealt.repartition("list", "tile").sortWithinPartitions("list", "tile")
    met = dealt.mapInArrow(_compare(percent), "a long, b long").distinct()
    return found.union(_verified(met, live, percent))


def classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least id reachable over links."""
    ship(docs.sparkSession)
    docs = identified(docs, id_col, text_col).withColumn("raw", F.xxhash64("text"))
    profiles = docs.select("doc_id", "raw", "text").mapInArrow(_profiles(shingle, percent), "doc_id long, raw long, n long, digest long, prefix binary")
    profiles = land(profiles, "jaccard-profiles")
    roots = components(land(links(docs, profiles, shingle, percent), "jaccard-all-links"))
    sets = profiles.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    sets = sets.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    named = sets.join(sets.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("digest", "component_id")
    rows = profiles.where("n > 0").join(named, "digest").select("doc_id", "n", "component_id")
    rows = rows.unionByName(profiles.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the set and component of every document (5-word shingles, 80 percent)."""
    return classes(table(spark, sf_dir, "documents"))
