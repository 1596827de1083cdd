"""Quality rules: statistics of each text, then cross-document line frequency per host.

One pass over the texts gives the statistics and, for every line with a word,
the hash of the normalised line (lower case, white space collapsed, numbers
alike) and its number of words; only these go on, not the texts. Distinct texts
that have a line are counted per host; copies of a text are one document, or a page
that was crawled often would make boilerplate of all its lines. Lines over a
limit are boilerplate and removed: over ``MAX_SHARE`` of a host's distinct texts
(and ``MIN_DOCS`` of them at least), or over ``MAX_DOCS`` of them however large
the host is. A document is depleted, and rejected, if
removal leaves under ``MIN_LEFT`` of its words.

Counting is by distinct (host, line, text) first, so a line of a third of all
documents is spread over the cluster, then a partial aggregate. The join of
documents with frequent lines drops the other lines first where adaptive
execution measures the frequent ones as small, and splits skewed keys otherwise.

Defined cases: null text counts as empty (no words, base_failed); null hosts
are a host of their own; null and repeated ids are fine, equal rows get equal
verdicts; an empty table gives an empty table; extra columns are kept by
``cleaned`` and ignored by ``judge``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import land, packed, ship, table, unpacked

#: Fixed values of the base rules.
SYMBOLS, WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = "#*$%&|<>", 5, 10, 20
SPACES = " \t\n\x0b\x0c\r"
#: Limits of the line rule.
MAX_SHARE, MIN_DOCS, MAX_DOCS, MIN_LEFT = 0.05, 10, 1000, 0.3

_DIGITS = re.compile(rb"[0-9]+")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64)
    mixed.sort()
    if (mixed[1:] != mixed[:-1]).all():  # equal windows have equal codes, so no two are equal
        return 0
    rank = ids[:n]
    for k in range(1, window):  # exact: ranks of ever longer windows
        rank = np.unique(rank * len(seen) + ids[k : k + n], return_inverse=True)[1] if len(seen) < 1 << 30 else _ranked(rank, ids[k : k + n])
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([a, b], axis=1), axis=0, return_inverse=True)[1].ravel()


def normalised(line: str) -> bytes:
    """Lower case, white space collapsed, every number alike."""
    return _DIGITS.sub(b"0", b" ".join(line.lower().encode().split()))


def line_hash(line: str) -> int:
    """Signed 64-bit hash of a normalised line."""
    h = xxhash.xxh64_intdigest(normalised(line), 42)
    return h - (1 << 64) if h >> 63 else h


def stats_of(text: str | None) -> dict:
    """Base statistics, and hash and size of every line with a word."""
    text = text or ""
    words = text.encode().split()
    seen: set[str] = set()
    dup, lines, sizes = 0, [], []
    for line in text.split("\n"):
        n = len(line.encode().split())
        if n:
            dup += line in seen
            seen.add(line)
            lines.append(line_hash(line))
            sizes.append(n)
    return {
        "n_words": len(words), "word_chars": len(text) - sum(map(text.count, SPACES)), "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": dup, "n_repeat_words": repeated_words(words), "lines": lines, "line_words": sizes,
    }


def stats(text: Column) -> Column:
    """Struct of ``stats_of`` for a text column."""

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    fields = pa.struct([*((n, pa.int64()) for n in names), ("lines", pa.list_(pa.int64())), ("line_words", pa.list_(pa.int32()))])

    @F.arrow_udf(f"struct<{','.join(n + ':bigint' for n in names)},lines:array<bigint>,line_words:array<int>>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([stats_of(t) for t in texts.to_pylist()], fields)

    return measure(text)


def _host(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def measured(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, host key, digest of the text and statistics of every row, written once."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _host(F.col(host_col)).alias("host"), F.xxhash64(text).alias("digest"), stats(text).alias("s"))
    return land(rows.select("doc_id", "host", "digest", "s.*"), "rules-stats")


def frequent_lines(rows: DataFrame) -> DataFrame:
    """(host, line): lines in too many of a host's distinct texts."""
    texts = rows.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("n_texts"))
    met = rows.select("host", "digest", F.explode(F.array_distinct("lines")).alias("line")).distinct()
    counts = met.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS)
    over = (F.col("n") > MAX_SHARE * F.col("n_texts")) | (F.col("n") > MAX_DOCS)
    return land(counts.join(texts, "host").where(over).select("host", "line"), "rules-lines")


def removed_lines(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(k_id, k_host, k_digest, n_lines_removed, n_words_removed, removed) of the rows that lose lines."""
    each = rows.select("doc_id", "host", "digest", F.posexplode(F.arrays_zip("lines", "line_words")).alias("at", "l"))
    each = each.select("doc_id", "host", "digest", "at", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    hits = each.join(frequent, ["host", "line"]).dropDuplicates(["doc_id", "host", "digest", "at"])
    lost = hits.groupBy("doc_id", "host", "digest").agg(F.count("*").alias("n_lines_removed"), F.sum("words").alias("n_words_removed"), F.collect_set("line").alias("removed"))
    return lost.withColumnsRenamed({"doc_id": "k_id", "host": "k_host", "digest": "k_digest"})


def _same(host: Column, digest: Column) -> Column:
    return F.col("doc_id").cast("long").eqNullSafe(F.col("k_id")) & (host == F.col("k_host")) & (digest == F.col("k_digest"))


def judge(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, statistics, base_failed, kept, and the words and lines that the line rule removes."""
    rows = measured(docs, host_col)
    lost = removed_lines(rows, frequent_lines(rows)).drop("removed")
    judged = rows.join(lost, _same(F.col("host"), F.col("digest")), "left")
    gone = F.coalesce("n_words_removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (gone > 0) & (F.col("n_words") - gone < MIN_LEFT * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"), gone.alias("n_words_removed"), F.coalesce("n_lines_removed", F.lit(0)).alias("n_lines_removed"),
    )


def cleaned(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """The rows that are kept, without their frequent lines."""
    rows = measured(docs, host_col)
    lost = removed_lines(rows, frequent_lines(rows))
    joined = packed(docs, host_col).join(lost, _same(_host(F.col("host")), F.xxhash64("text")), "left")

    @F.arrow_udf("struct<text:string,failed:boolean>")
    def strip(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            out = []
            for t, drop in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
                found, drop = stats_of(t), set(drop or ())
                kept = [x for x in (t or "").split("\n") if not (x.encode().split() and line_hash(x) in drop)] if drop else None
                left = found["n_words"] - sum(n for h, n in zip(found["lines"], found["line_words"], strict=True) if h in drop)
                failed = found["n_words"] < MIN_WORDS or 100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"]
                out.append({"text": t if kept is None else "\n".join(kept), "failed": failed or bool(drop) and left < MIN_LEFT * found["n_words"]})
            yield pa.array(out, pa.struct([("text", pa.string()), ("failed", pa.bool_())]))

    judged = joined.withColumn("s", strip(F.col("row").getField("text"), F.col("removed"))).where("NOT s.failed")
    return unpacked(judged, docs.columns, {"text": F.col("s.text")})


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document; its source is its host."""
    return judge(table(spark, sf_dir, "documents"))


_WORDS = r"'[^\x20\x09-\x0D]+'"
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws
  FROM documents
), grams AS (
  SELECT rid, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d WHERE len(ws) >= {WINDOW})
), twice AS (
  SELECT rid, k FROM grams GROUP BY rid, k HAVING count(*) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT g.rid, unnest(range(g.i, g.i + {WINDOW})) AS p FROM grams g JOIN twice USING (rid, k)) GROUP BY rid
), lines AS (
  SELECT rid, host, text, line, len(regexp_extract_all(line, {_WORDS})) AS words,
         regexp_replace(array_to_string(regexp_extract_all(lower(line), {_WORDS}), ' '), '[0-9]+', '0', 'g') AS norm
  FROM (SELECT rid, host, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, {_WORDS})
), dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid
), frequent AS (
  SELECT l.host, l.norm FROM lines l JOIN (SELECT host, count(DISTINCT text) AS n_texts FROM d GROUP BY host) h USING (host)
  GROUP BY l.host, l.norm, n_texts
  HAVING count(DISTINCT l.text) >= {MIN_DOCS} AND (count(DISTINCT l.text) > CAST({MAX_SHARE} AS DOUBLE) * n_texts OR count(DISTINCT l.text) > {MAX_DOCS})
), lost AS (
  SELECT rid, count(*) AS n_lines, CAST(sum(words) AS BIGINT) AS n_words FROM lines JOIN frequent USING (host, norm) GROUP BY rid
), s AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         coalesce(lost.n_words, 0) AS n_words_removed, coalesce(lost.n_lines, 0) AS n_lines_removed
  FROM d LEFT JOIN covered USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid)
), f AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s
)
SELECT *, NOT base_failed AND NOT (n_words_removed > 0 AND n_words - n_words_removed < CAST({MIN_LEFT} AS DOUBLE) * n_words) AS kept FROM f
"""
