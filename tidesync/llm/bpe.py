"""Byte-level BPE encoding and decoding with DuckDB recursive queries per partition.

Each task splits its texts into pre-tokens. The distinct pre-tokens it has not
met yet become token-position rows of an in-process DuckDB table, one row per
byte that knows the token after it. A recursive query joins these pairs with
the merge table and contracts the leftmost pair of least rank of every
pre-token, until no pair merges. Decoding joins (position, id) rows with the
vocabulary in the order of their positions; a document's bytes are those of its
run of positions.

No row leaves its task: encoding and decoding are narrow, need no shuffle, and
a lost executor costs only its own tasks. Memory per Python worker is bounded
by one Arrow batch (its texts are coded ``SLICE_BYTES`` at a time), DuckDB's
memory limit and the memo of pre-tokens (``MEMO_BYTES``; it starts anew when
full, which changes no result). Memo and DuckDB are closed when the task ends:
a reused worker would hold them while other stages run.

Ids travel packed: little-endian unsigned 32-bit integers in a BINARY column,
so ``length(ids) / 4`` is the token count and ``sha2(ids, 256)`` the digest.

Defined cases: null text encodes as the empty text (no ids); empty text has no
ids and decodes to zero bytes; null ids decode to null; repeated rows each keep
their row; an empty table gives an empty table; other columns pass through
untouched unless they have the name of an output column, which is replaced.
"""

from __future__ import annotations

import base64
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identified, table

#: Bytes of pre-tokens (and their ids) memorised by a task before the memo starts anew, and what an entry takes beside its own.
MEMO_BYTES, ENTRY_BYTES = 96 << 20, 240
#: Bytes of texts (or ids) coded at once.
SLICE_BYTES = 4 << 20
#: Pre-token occurrences held before their texts are assembled.
GROUP_WORDS = 500_000
#: Pre-tokens encoded by one recursive query.
QUERY_WORDS = 40_000
#: Token rows decoded by one query (a document is never split).
QUERY_TOKENS = 1_000_000
#: Pre-tokens of more bytes than this are contracted with a heap: one round of
#: the recursive query a merge would make their cost quadratic in their length.
LONG_WORD = 256
DUCKDB_MEMORY = "200MB"

#: ``place`` is a pre-token's number times 4096 plus the byte a token starts at; ``nxt`` and ``ntok`` are the place and
#: the token after it. The last token of a pre-token has ``ntok`` ``NO_TOKEN``, which pairs with none.
ENCODE_SQL = """
WITH RECURSIVE step AS (
  SELECT place, tok, nxt, ntok, 0 AS round FROM units
  UNION ALL
  SELECT s.place, CASE WHEN s.place = b.spot THEN b.merged ELSE s.tok END,
         CASE WHEN s.place = b.spot THEN b.nxt ELSE s.nxt END,
         CASE WHEN s.place = b.spot THEN b.ntok WHEN s.nxt = b.spot THEN b.merged ELSE s.ntok END, s.round + 1
  FROM step s JOIN (
    SELECT least.*, q.nxt, q.ntok
    FROM (
      SELECT word, min(cand) >> 24 AS merged, (word << 12) + ((min(cand) >> 12) & 4095) AS spot, (word << 12) + (min(cand) & 4095) AS gone
      FROM (
        SELECT p.place >> 12 AS word, (m.tok::BIGINT << 24) + ((p.place & 4095) << 12) + (p.nxt & 4095) AS cand
        FROM step p JOIN merges m ON m.pair = (p.tok << 24) + p.ntok)
      GROUP BY word) least
    JOIN step q ON q.place = least.gone) b ON s.place >> 12 = b.word
  WHERE s.place <> b.gone
)
SELECT place, tok, round FROM step
"""
NO_TOKEN = -(1 << 40)

DECODE_SQL = "SELECT bytes FROM tokens LEFT JOIN vocab USING (tok) ORDER BY pos"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, from a rank file (one base64 token and its rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of tokens (left times 2**24 plus right) that makes a token, and that token."""
    left, right, merged = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                merged.append(rank)
    return np.array(left, np.int64) * 16777216 + np.array(right, np.int64), np.array(merged, np.int32)


class Codec:
    """One task's merge table, vocabulary and memo."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, merges: tuple[np.ndarray, np.ndarray] | None = None):
        import duckdb
        import regex

        if len(ranks) >= 1 << 23 or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary needs all 256 bytes and fewer than 2**23 tokens")
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY})
        self.fill("merges", pa.table(dict(zip(("pair", "tok"), merges or merges_of(ranks), strict=True))))
        self.fill("vocab", pa.table({"tok": pa.array(ranks.values(), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())}))

    def close(self) -> None:
        self.forget()
        self.con.close()
        pa.default_memory_pool().release_unused()

    def forget(self) -> None:
        #: Numbers of the pre-tokens met, in the order met, and the packed ids of each.
        self.memo: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.ids: list[bytes] = []
        self.held = 0

    def fill(self, name: str, rows: pa.Table) -> None:
        self.con.register("incoming", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def coded(self, words: list[str]) -> list[bytes]:
        """The packed ids of each of ``words``, by the recursive query."""
        out = [w.encode() for w in words]
        short = []
        for k, b in enumerate(out):
            if (rank := self.ranks.get(b)) is not None:
                out[k] = rank.to_bytes(4, "little")
            elif len(b) > LONG_WORD:
                out[k] = np.array(contract(b, self.ranks), "<u4").tobytes()
            else:
                short.append(k)
        for k in range(0, len(short), QUERY_WORDS):
            part = short[k : k + QUERY_WORDS]
            raw = [out[i] for i in part]
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            flat = np.frombuffer(b"".join(raw), np.uint8)
            start = np.repeat(np.cumsum(size) - size, size)
            word = np.repeat(np.arange(len(part), dtype=np.int64), size)
            place, tok = word * 4096 + np.arange(len(flat)) - start, self.single[flat].astype(np.int64)
            nxt, ntok = np.append(place[1:], -1), np.append(tok[1:], NO_TOKEN)
            last = np.cumsum(size) - 1
            nxt[last], ntok[last] = -1, NO_TOKEN
            units = pa.table({"place": place, "tok": tok, "nxt": nxt, "ntok": ntok})
            self.con.register("units", units)
            steps = self.con.sql(ENCODE_SQL).to_arrow_table()
            self.con.unregister("units")
            place, tok, step = (steps[c].to_numpy() for c in ("place", "tok", "round"))
            owner, last = place >> 12, np.zeros(len(part), step.dtype)
            np.maximum.at(last, owner, step)  # the round in which nothing was left to merge
            done = np.nonzero(step == last[owner])[0]
            done = done[np.argsort(place[done])]
            ids = tok[done].astype("<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(owner[done], minlength=len(part)))).tolist()
            for i, a, z in zip(part, [0, *ends[:-1]], ends, strict=True):
                out[i] = ids[a:z]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        group: list[list[int]] = []
        held = 0

        def flush() -> None:
            fresh = list(itertools.islice(self.memo, len(self.ids), None))
            ids = self.coded(fresh)
            self.ids += ids
            self.held += sum(map(len, fresh)) + sum(map(len, ids)) + ENTRY_BYTES * len(ids)
            out.extend(b"".join(map(self.ids.__getitem__, numbers)) for numbers in group)
            group.clear()
            if self.held > MEMO_BYTES:
                self.forget()

        for text in texts:
            numbers = list(map(self.memo.__getitem__, self.find(text))) if text else []
            group.append(numbers)
            held += len(numbers)
            if len(self.memo) - len(self.ids) >= QUERY_WORDS or held >= GROUP_WORDS:
                flush()
                held = 0
        flush()
        return out

    def decode(self, packed: list[bytes | None]) -> list[bytes | None]:
        out: list[bytes | None] = []
        k = 0
        while k < len(packed):
            n, stop = 0, k
            while stop < len(packed) and (stop == k or n + len(packed[stop] or b"") // 4 <= QUERY_TOKENS):
                n += len(packed[stop] or b"") // 4
                stop += 1
            part = packed[k:stop]
            ends = np.cumsum([0, *(len(p or b"") // 4 for p in part)])
            got: list[bytes] = [b""] * len(part)
            if n:
                ids = np.frombuffer(b"".join(p or b"" for p in part), "<u4")
                self.con.register("tokens", pa.table({"pos": np.arange(n, dtype=np.int32), "tok": ids.astype(np.int32)}))
                found = pa.concat_arrays(self.con.sql(DECODE_SQL).to_arrow_table()["bytes"].chunks)
                self.con.unregister("tokens")
                _, offsets, flat = found.buffers()
                at = np.frombuffer(offsets, np.int32)[found.offset + ends].tolist()
                data = memoryview(flat or b"")
                got = [bytes(data[a:z]) for a, z in zip(at[:-1], at[1:], strict=True)]
            out.extend(None if p is None else b for p, b in zip(part, got, strict=True))
            k = stop
        return out


def contract(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long pre-token: the leftmost pair of least rank is merged until none is left, in n log n steps."""
    import heapq

    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    nxt, prv = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(word) - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if parts[i] != a or j >= len(word) or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        nxt[i] = nxt[j]
        if nxt[i] < len(word):
            prv[nxt[i]] = i
        for x, y in ((prv[i], i), (i, nxt[i])):
            if x >= 0 and y < len(word) and (r := ranks.get(parts[x] + parts[y])) is not None:
                heapq.heappush(heap, (r, x, parts[x], parts[y]))
    return [ranks[p] for p in parts if p is not None]


def _shared(spark: SparkSession, vocab_path: str):
    # The vocabulary and its merges are constants of the tokenizer (about 2 MB here), whatever the size of the data.
    ranks = read_ranks(vocab_path)
    return spark.sparkContext.broadcast((ranks, merges_of(ranks)))


def _slices(values: pa.Array) -> Iterator[pa.Array]:
    """``values`` (text or binary) in slices of about ``SLICE_BYTES``; one value is never split."""
    size = np.cumsum(np.append(0, pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False)))
    at = 0
    while at < len(values):
        end = max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES, side="right")) - 1)
        yield values.slice(at, end - at)
        at = end


def _coded(shared, pattern: str, kind: pa.DataType, code):
    """A function over batches: ``code`` of a task's codec over slices; the codec is closed with the task."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks, merges = shared.value
        codec = Codec(ranks, pattern, merges)
        try:
            for values in batches:
                parts = [code(codec, part.to_pylist()) for part in _slices(values)]
                yield pa.concat_arrays(parts) if parts else pa.array([], kind)
        finally:
            codec.close()

    return run


def encode(text: Column, spark: SparkSession, vocab_path: str, pattern: str) -> Column:
    """The packed ids of ``text``; null counts as empty."""
    run = _coded(_shared(spark, vocab_path), pattern, pa.binary(), lambda codec, texts: pa.array(codec.encode(texts), pa.binary()))

    @F.arrow_udf("binary")
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(batches)

    return encode_texts(text)


def decode(ids: Column, spark: SparkSession, vocab_path: str, pattern: str) -> Column:
    """The bytes that packed ``ids`` stand for; null stays null."""
    run = _coded(_shared(spark, vocab_path), pattern, pa.binary(), lambda codec, packed: pa.array(codec.decode(packed), pa.binary()))

    @F.arrow_udf("binary")
    def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(batches)

    return decode_ids(ids)


def round_trip(text: Column, spark: SparkSession, vocab_path: str, pattern: str) -> Column:
    """Struct of the packed ids of ``text`` and the bytes decoded from them, both made by one worker."""

    def code(codec: Codec, texts: list[str | None]) -> pa.Array:
        ids = codec.encode(texts)
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(codec.decode(ids), pa.binary())], ["ids", "decoded"])

    run = _coded(_shared(spark, vocab_path), pattern, pa.struct([("ids", pa.binary()), ("decoded", pa.binary())]), code)

    @F.arrow_udf("struct<ids:binary,decoded:binary>")
    def round_trips(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(batches)

    return round_trips(text)


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (packed) and ``decoded`` (the bytes decoded from the ids)."""
    coded = docs.withColumn("__coded", round_trip(F.col(text_col), docs.sparkSession, vocab_path, pattern))
    return coded.withColumns({"ids": F.col("__coded.ids"), "decoded": F.col("__coded.decoded")}).drop("__coded")


def digests(docs: DataFrame, vocab_path: str, pattern: str) -> DataFrame:
    """doc_id, token count and digests of the ids and of the decoded bytes, a row per document."""
    coded = encode_documents(identified(docs, "doc_id", "text"), vocab_path, pattern)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def byte_vocabulary() -> tuple[str, str]:
    """Path of the public byte-level rank file, and the pattern that splits texts for it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded again."""
    return digests(table(spark, sf_dir, "documents"), *byte_vocabulary())
