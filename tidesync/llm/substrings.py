"""Substring deduplication by hashes of windows, partitioned by prefixes.

A text's suffixes start at its words. They are split among groups by prefixes
of variable length: a histogram of hashed prefixes of 1, 2, 4, ... words over
the whole corpus finds, for each suffix, the shortest prefix whose suffixes fit
in memory together; the groups are as many as the corpus needs, and several
prefixes share one. Equal windows have equal prefixes, so they always meet in
one group. The histogram has a fixed number of bins: where a corpus outgrows
them, prefixes get longer, up to the whole window.

No suffix tree is built: each group sorts the hashes of its suffixes' first
``window`` words, and equal hashes (a node, with its places as leaves) are the
places where one sequence of words starts. Runs of neighbouring repeated places,
joined up, are what ``maximal_repeats`` gives. Every place whose window is also
in a document with a smaller id is a repeat, and its words are removed.

What travels is 8 bytes a window and a few for its place, packed, not words.
Windows are first reduced inside each task: of the places of one window only
those of the task's smallest document go on, the others are known repeats. A
passage in a third of all documents thus sends one place a task.

Windows are told apart by 64-bit hashes within a group (and the group itself
is chosen by an independent hash): 10^8 windows have a chance of about one in
four thousand of holding a single false match.

Defined cases: null and empty texts have no words, nothing removed and the
digest of no bytes; texts shorter than a window are kept whole; rows with a
null id neither remove nor lose anything; rows with equal ids never remove from
each other; repeated rows each keep a row; an empty table gives an empty table;
extra columns are kept by ``deduplicated`` and ignored by ``report``. (Rows of
one id with different texts are told apart by 32 bits of a text hash.)
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import land, packed, ship, table, unpacked

WINDOW = 13
#: Suffixes of one prefix that stay together; a group holds about as many in all (under 100 MB while it is sorted).
GROUP_SUFFIXES = 1_200_000
#: Bins of the histogram for each prefix length: all that is kept of it is a bit for each.
BINS, BIN_BLOCK = 1 << 14, 1 << 10
#: Bytes of text whose windows are reduced together in a task.
REDUCE_BYTES = 6 << 20
#: Groups that places known to be repeats are spread over, so that they need no sorting with the others.
KNOWN_GROUPS = 256
#: Repeated places that a task holds before it hands them on.
HAND_ON = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def prefix_hashes(h: np.ndarray, lengths: list[int], salt: int = 0) -> list[np.ndarray]:
    """Hashes of the first words of every run of ``lengths[-1]`` word hashes, for each length (ascending)."""
    n, out = max(0, len(h) - lengths[-1] + 1), []
    mixed, factor = np.full(n, salt, np.uint64), _MIX + np.uint64(2 * salt)
    for k in range(lengths[-1]):
        mixed = mixed * factor + h[k : k + n]
        if k + 1 in lengths:
            out.append(_finish(mixed))
    return out


def depths(window: int) -> list[int]:
    """Prefix lengths tried: 1, 2, 4, ... and the whole window."""
    return [1 << k for k in range(window.bit_length()) if 1 << k < window] + [window]


def prefix_bins(h: np.ndarray, window: int, bins: int) -> list[np.ndarray]:
    """For each prefix length, the bin of every window."""
    return [(x & np.uint64(bins - 1)).astype(np.int32) for x in prefix_hashes(h, depths(window), salt=77)]


class Batch:
    """Word hashes of several texts in a row, and which windows lie within one text."""

    def __init__(self, texts: list[list[bytes]], window: int):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.hashes = np.fromiter((x for words in texts for x in map(xxhash.xxh3_64_intdigest, words)), np.uint64, int(size.sum()))
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
        whole = (place <= size[doc] - window)[: max(0, len(doc) - window + 1)]
        self.at = np.nonzero(whole)[0]
        self.doc, self.place = doc[self.at], place[self.at].astype(np.uint32)


class Groups:
    """Which group a suffix belongs to: by the shortest of its prefixes whose bin is small enough."""

    def __init__(self, counts: np.ndarray, window: int, limit: int):
        self.window, self.bins = window, counts.shape[1]
        self.small = counts <= limit
        self.small[-1] = True  # a whole window can't be split further, but is reduced in every task
        self.groups = max(1, math.ceil(int(counts[-1].sum()) / limit))

    def of(self, batch: Batch) -> np.ndarray:
        out = None
        for level, prefix in reversed(list(enumerate(prefix_hashes(batch.hashes, depths(self.window), salt=77)))):
            prefix = prefix[batch.at]
            own = ((prefix >> np.uint64(24)) % np.uint64(self.groups)).astype(np.int32)
            out = own if out is None else np.where(self.small[level][(prefix & np.uint64(self.bins - 1)).astype(np.int32)], own, out)
        return out


def _batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[list[int], list[int], Batch]]:
    """(ids, digests, words) of whole texts of at least a window, some ``REDUCE_BYTES`` at once."""
    ids, digests, texts, held = [], [], [], 0
    for batch in batches:
        columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())
        for doc_id, digest, text in zip(*columns, strict=True):
            words = text.split()
            if len(words) >= window:
                ids.append(doc_id)
                digests.append(digest)
                texts.append(words)
                held += len(text)
            if held >= REDUCE_BYTES:
                yield ids, digests, Batch(texts, window)
                ids, digests, texts, held = [], [], [], 0
    if ids:
        yield ids, digests, Batch(texts, window)


def _histogram(docs: DataFrame, window: int, bins: int) -> np.ndarray:
    """Suffixes in each bin, by prefix length, over the whole corpus; its size is a parameter, not the corpus's."""
    n_depths, block = len(depths(window)), min(bins, BIN_BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_depths, bins), np.int64)
        for _, _, batch in _batches(batches, window):
            for level, found in enumerate(prefix_bins(batch.hashes, window, bins)):
                sums[level] += np.bincount(found[batch.at], minlength=bins)
        parts = sums.reshape(-1, block)
        yield pa.record_batch({"part": np.arange(len(parts), dtype=np.int32), "sums": pa.array([x.tobytes() for x in parts], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, np.zeros(block, np.int64)
        for batch in batches:
            part = batch.column(0)[0].as_py()
            for x in batch.column(1).to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.record_batch({"part": pa.array([part], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, sums binary"
    found = docs.mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    out = np.zeros((n_depths * bins // block, block), np.int64)
    for r in found:
        out[r.part] = np.frombuffer(r.sums, np.int64)
    return out.reshape(n_depths, bins)


_ROW = [("doc", "<i8"), ("digest", "<i8")]
_SPANS = "doc_id long, digest long, spans binary"
_SENT = "grp int, hashes binary, rows binary, counts binary, places binary"


def _send(window: int, groups: Groups):
    """Per task: windows reduced to the places of their smallest document, packed by group."""

    def packed(ids: list[int], digests: list[int], batch: Batch) -> Iterator[pa.RecordBatch]:
        key, digest = np.array(ids, np.int64), np.array(digests, np.int64)
        code, grp = prefix_hashes(batch.hashes, [window])[0][batch.at], groups.of(batch)
        order = np.argsort(code, kind="stable")
        ordered, owner = code[order], key[batch.doc[order]]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        least = np.minimum.reduceat(owner, np.nonzero(first)[0])[np.cumsum(first) - 1]
        # Known repeats carry their places alone, to groups with negative numbers.
        grp[order[owner > least]] = -1 - TaskContext.get().partitionId() % KNOWN_GROUPS
        order = np.argsort(grp, kind="stable")  # by document and place within a group, as they were
        code, grp, doc, place = code[order], grp[order], batch.doc[order], batch.place[order]
        out: dict[str, list] = {"grp": [], "hashes": [], "rows": [], "counts": [], "places": []}
        for a, z in _runs(grp):
            starts = np.array([s for s, _ in _runs(doc[a:z])], np.int64)
            rows = _rows_packed(key[doc[a + starts]], digest[doc[a + starts]])
            counts = np.diff(np.append(starts, z - a)).astype("<u4")
            out["grp"].append(int(grp[a]))
            out["hashes"].append(b"" if grp[a] < 0 else code[a:z].tobytes())
            out["rows"].append(rows)
            out["counts"].append(_counts_packed(counts))
            out["places"].append(_squeezed(place[a:z], counts))
        for k in range(0, len(out["grp"]), 64):
            yield pa.record_batch([pa.array(v[k : k + 64], pa.int32() if c == "grp" else pa.binary()) for c, v in out.items()], names=list(out))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, digests, batch in _batches(batches, window):
            yield from packed(ids, digests, batch)

    return reduce


def _runs(sorted_values: np.ndarray) -> list[tuple[int, int]]:
    cut = np.nonzero(sorted_values[1:] != sorted_values[:-1])[0] + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(sorted_values)], strict=True))


def _planes(values: np.ndarray) -> bytes:
    """Unsigned integers byte plane by byte plane, so that shuffles compress their empty high bytes away."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplaned(data: bytes, kind: str, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel()


def _squeezed(place: np.ndarray, counts: np.ndarray) -> bytes:
    """Places as gaps within each document's run: two bytes each, four where a gap needs them."""
    gap = np.diff(place.astype(np.int64), prepend=0)
    starts = np.cumsum(counts.astype(np.int64)) - counts
    gap[starts] = place[starts]
    return b"\x02" + _planes(gap.astype("<u2")) if gap.max() < 1 << 16 else b"\x04" + _planes(gap.astype("<u4"))


def _widened(data: bytes, counts: np.ndarray) -> np.ndarray:
    gap = _unplaned(data[1:], "<u2" if data[0] == 2 else "<u4", int(counts.sum())).astype(np.int64)
    total = np.cumsum(gap)
    starts = np.cumsum(counts.astype(np.int64)) - counts
    return total - np.repeat(total[starts] - gap[starts], counts)


def _rows_packed(docs: np.ndarray, digests: np.ndarray) -> bytes:
    """Ids (as distances from the least, four bytes where they fit) and 32 bits of each digest."""
    least = int(docs.min())
    wide = int(docs.max()) - least >= 1 << 32
    far = (docs.view(np.uint64) - np.uint64(least % (1 << 64))).astype("<u8" if wide else "<u4")
    return bytes([wide]) + least.to_bytes(8, "little", signed=True) + _planes(far) + (digests & 0xFFFFFFFF).astype("<u4").tobytes()


def _rows_unpacked(data: bytes) -> np.ndarray:
    wide = data[0]
    n = (len(data) - 9) // (12 if wide else 8)
    far = _unplaned(data[9 : len(data) - 4 * n], "<u8" if wide else "<u4", n).astype(np.uint64)
    rows = np.empty(n, _ROW)
    rows["doc"] = (far + np.frombuffer(data, "<u8", 1, 1)[0]).view(np.int64)
    rows["digest"] = np.frombuffer(data, "<u4", n, len(data) - 4 * n)
    return rows


def _counts_packed(counts: np.ndarray) -> bytes:
    return b"\x02" + _planes(counts.astype("<u2")) if counts.max() < 1 << 16 else b"\x04" + _planes(counts.astype("<u4"))


def _counts_unpacked(data: bytes) -> np.ndarray:
    kind = "<u2" if data[0] == 2 else "<u4"
    return _unplaned(data[1:], kind, (len(data) - 1) // int(kind[-1])).astype(np.int64)


class Found:
    """Repeated places of a task, handed on by bucket of their document."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.held = buckets, [], 0

    def add(self, rows: np.ndarray, owner: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((rows["doc"][owner], rows["digest"][owner], place.astype(np.uint32)))
        self.held += len(owner)
        if self.held >= HAND_ON:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            doc, digest, place = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
            bucket = (_finish(doc.view(np.uint64) * _MIX + digest.astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int32)
            order = np.lexsort((place, doc, bucket))
            bucket, doc, digest, place = bucket[order], doc[order], digest[order], place[order]
            out: dict[str, list] = {"bucket": [], "docs": [], "digests": [], "places": []}
            for a, z in _runs(bucket):
                out["bucket"].append(int(bucket[a]))
                out["docs"].append(_planes(doc[a:z].astype("<i8")))
                out["digests"].append(_planes(digest[a:z].astype("<u4")))
                out["places"].append(_planes(place[a:z].astype("<u4")))
            yield pa.record_batch([pa.array(v, pa.int32() if c == "bucket" else pa.binary()) for c, v in out.items()], names=list(out))
        self.parts, self.held = [], 0


_HANDED = "bucket int, docs binary, digests binary, places binary"


def _subtrees(buckets: int):
    """Streams a partition's packed suffixes, sorted by group, one group after another."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, group, held = Found(buckets), None, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if row[0] != group and held:
                    yield from _repeats(held, found)
                    held = []
                group = row[0]
                held.append(row[1:])
        if held:
            yield from _repeats(held, found)
        yield from found.flush()

    def _repeats(held: list[tuple], found: Found) -> Iterator[pa.RecordBatch]:
        """One group: its suffixes sorted, and the places below nodes that a smaller document reaches too."""
        rows, codes, owners, places, n = [], [], [], [], 0
        for h, r, c, p in held:
            counts = _counts_unpacked(c)
            unpacked_rows, place = _rows_unpacked(r), _widened(p, counts)
            if not h:  # their task knew them to be repeats
                yield from found.add(unpacked_rows, np.repeat(np.arange(len(counts)), counts), place)
                continue
            rows.append(unpacked_rows)
            codes.append(np.frombuffer(h, np.uint64))
            owners.append(np.repeat(np.arange(n, n + len(counts), dtype=np.int32), counts))
            places.append(place.astype(np.uint32))
            n += len(counts)
        if not rows:
            return
        every, code = np.concatenate(rows), np.concatenate(codes)
        owner, place = np.concatenate(owners), np.concatenate(places)
        del rows, codes, owners, places
        order = np.argsort(code, kind="stable")
        ordered = code[order]
        same = np.empty(len(code), bool)
        same[0], same[1:] = False, ordered[1:] == ordered[:-1]
        shared = same.copy()
        shared[:-1] |= same[1:]
        order, node = order[shared], np.cumsum(~same)[shared]  # only nodes with two leaves or more
        if len(node):
            doc = every["doc"][owner[order]]
            start = np.concatenate(([True], node[1:] != node[:-1]))
            least = np.minimum.reduceat(doc, np.nonzero(start)[0])[np.cumsum(start) - 1]
            order = order[doc > least]
            yield from found.add(every, owner[order], place[order])

    return go


def _maximal(window: int):
    """One bucket of documents: the maximal runs of words that repeated windows cover, packed, a row a document."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for d, g, p in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                n = len(d) // 8
                parts.append((_unplaned(d, "<i8", n), _unplaned(g, "<u4", n), _unplaned(p, "<u4", n)))
        doc, digest, place = (np.concatenate([x[k] for x in parts]) for k in range(3))
        order = np.lexsort((place, digest, doc))
        doc, digest, place = doc[order], digest[order], place[order].astype(np.int64)
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])
        cut = fresh.copy()
        cut[1:] |= place[1:] > place[:-1] + window
        first = np.nonzero(cut)[0]
        spans = np.stack([place[first], place[np.append(first[1:], len(place)) - 1] + window], axis=1).astype("<u4")
        at = np.append(np.nonzero(fresh[first])[0], len(first)).tolist()
        for k in range(0, len(at) - 1, 5000):
            mine = list(zip(at[k : k + 5001], at[k + 1 : k + 5001], strict=False))
            own = first[[a for a, _ in mine]]
            yield pa.record_batch({
                "doc_id": doc[own], "digest": digest[own].astype(np.int64), "spans": pa.array([spans[a:z].tobytes() for a, z in mine], pa.binary()),
            })

    return go


def repeats(docs: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(doc_id, digest, spans): packed pairs of the first word and the end of each maximal run of words that repeated
    windows cover, a row per document that has any."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text")).where("doc_id IS NOT NULL")
    groups = Groups(_histogram(plain, window, BINS), window, group_suffixes)
    shared = docs.sparkSession.sparkContext.broadcast(groups)  # a bit for each bin: a constant
    sent = plain.mapInArrow(lambda batches: _send(window, shared.value)(batches), _SENT)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = sent.repartition("grp").sortWithinPartitions("grp").mapInArrow(_subtrees(buckets), _HANDED)
    return found.groupBy("bucket").applyInArrow(_maximal(window), _SPANS)


def _with_spans(docs: DataFrame, window: int, group_suffixes: int) -> DataFrame:
    """Packed rows of ``docs`` with their repeated spans (null: none)."""
    found = land(repeats(docs, window, group_suffixes), "repeats")
    found = found.select(F.col("doc_id").alias("s_id"), F.col("digest").alias("s_digest"), "spans")
    same = (F.col("doc_id") == F.col("s_id")) & (F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("s_digest"))
    return packed(docs).join(found, same, "left")


def kept_words(text: Column, spans: Column) -> Column:
    """Struct of n_words, n_removed and the kept words joined by one space."""

    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def keep(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        for texts, lists in batches:
            out = []
            for t, found in zip(texts.cast(pa.binary()).to_pylist(), lists.to_pylist(), strict=True):
                words, left, at = (t or b"").split(), [], 0
                for first, end in np.frombuffer(found or b"", "<u4").reshape(-1, 2).tolist():
                    left += words[at:first]
                    at = end
                left += words[at:]
                out.append({"n_words": len(words), "n_removed": len(words) - len(left), "kept": b" ".join(left).decode()})
            yield pa.array(out, kind)

    return keep(text, spans)


def report(docs: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words of every row."""
    rows = _with_spans(docs.select("doc_id", "text"), window, group_suffixes)
    rows = rows.select("doc_id", kept_words(F.col("text"), F.col("spans")).alias("k"))
    return rows.select("doc_id", "k.n_words", "k.n_removed", F.sha2(F.col("k.kept").cast("binary"), 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """``docs`` with repeated passages removed from ``text`` (texts without any are untouched)."""
    rows = _with_spans(docs, window, group_suffixes).withColumn("k", kept_words(F.col("text"), F.col("spans")))
    text = F.when(F.col("k.n_removed") > 0, F.col("k.kept")).otherwise(F.col("row").getField("text"))
    return unpacked(rows, docs.columns, {"text": text})


def maximal_repeats(docs: DataFrame, window: int = WINDOW, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """(doc_id, start, end): the maximal runs of words, end exclusive, that repeated windows cover."""

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed_spans = batch.column(2).to_pylist()
            pairs = np.frombuffer(b"".join(packed_spans), "<u4").reshape(-1, 2).astype(np.int64)
            doc = np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in packed_spans])
            yield pa.record_batch({"doc_id": doc, "start": pairs[:, 0], "end": pairs[:, 1]})

    return repeats(docs, window, group_suffixes).mapInArrow(apart, "doc_id long, start long, end long")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, and those left when repeated windows go."""
    return report(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT rid, doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d WHERE len(ws) >= {WINDOW})
), firsts AS (
  SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM windows JOIN firsts USING (k) WHERE first_id < doc_id)
), words AS (
  SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
