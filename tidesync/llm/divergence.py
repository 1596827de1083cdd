"""Source divergence audit: how far the term use of each source of a language is from the others and from the whole.

Terms are counted where texts are read, so a row is a (language, source, term)
of many documents before anything is shuffled. A term kept by its language
becomes one row with its counts by source; all shares are exact integers.

Terms that set a source apart are ranked by count cells: terms of a source that
have the same count there and in the whole language have the same value, so the
value is worked out once a cell. Cells of equal value are merged, the values
with their multiplicities are ranked, and only the terms of cells that can reach
the ranks asked for are looked up and put in UTF-8 order. A value that
millions of terms share gives each task its first terms only, by Spark's limit
on ranks within groups.

Divergences between two sources need every kept term, also those neither has.
Tasks lay the counts of some thousand terms out as a table of terms by sources,
and send one partial sum for each pair of sources; no row is made for a pair and
a term.

What grows with the sources: the list of (language, source) with their sizes
goes to the driver and to all tasks, a kept term's row has one count for each
source that uses it, a task's table has 4096 terms or more times the language's
sources, and its sums are one for each pair of these. The result has a row for every pair of sources of a
language, the square of that.

Defined cases: null text, language and source count as empty; a language whose
terms are all too rare keeps none: its pairs have value 0 and it has no terms;
a source without terms has zero counts; a language of one source has no pairs;
repeated rows are documents of their own; ids play no part; an empty table
gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import land, ship, table

MIN_DOCS, TOP = 3, 200
#: Shares are parts of this.
SCALE = 1_000_000_000
#: Counts of a table of terms by sources, about; it has 4096 terms at least.
CELLS = 1 << 20
#: Bytes of texts that are counted at once; a longer text is counted by itself, in blocks of as many.
BLOCK = 1 << 23

#: A-Z become a-z; every other ASCII character but a-z parts terms.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _batch(keys: list[tuple[str, str]], at: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """Rows of ``terms``, each of the key at ``at``."""
    at = pa.array(at, pa.int64())
    lang, source = (pa.array([k[i] for k in keys], pa.string()).take(at) for i in range(2))
    return pa.record_batch({"lang": lang, "source": source, "term": terms.cast(pa.string()), "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())})


def _count_texts(keys: list[tuple[str, str]], texts: list[bytes]) -> pa.RecordBatch:
    """Occurrences and documents of every (key, term) of some texts in translated letters, a key each."""
    names = list(dict.fromkeys(keys))
    place = {k: i for i, k in enumerate(names)}
    group = np.fromiter((place[k] for k in keys), np.int64, len(keys))
    flat = np.frombuffer(b" ".join(texts), np.uint8)
    edge = np.diff(np.concatenate(([0], (flat != 32).view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.append(0, np.cumsum(end - start)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(flat[flat != 32])]).dictionary_encode()
    size = max(1, len(words.dictionary))
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    in_text, n = np.unique(text * size + words.indices.to_numpy(), return_counts=True)  # a document's terms
    both, of = np.unique(group[in_text // size] * size + in_text % size, return_inverse=True)
    terms = words.dictionary.take(pa.array(both % size))
    return _batch(names, both // size, terms, np.bincount(of, weights=n, minlength=len(both)).astype(np.int64), np.bincount(of, minlength=len(both)))


def _count_long(key: tuple[str, str], text: bytes) -> pa.RecordBatch:
    """The same for one text, a block after the other."""
    times, at = Counter(), 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK)
        end = len(text) if end < 0 else end
        times.update(text[at:end].split())
        at = end
    return _batch([key], np.zeros(len(times), np.int64), pa.array(times.keys(), pa.binary()), np.array(list(times.values()), np.int64), np.ones(len(times), np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences and documents, summed over about ``BLOCK`` bytes of texts."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
            text = text.as_py().translate(_LETTERS)
            if len(text) > BLOCK:
                yield _count_long((lang, source), text)
                continue
            keys.append((lang, source))
            texts.append(text)
            held += len(text)
            if held >= BLOCK:
                yield _count_texts(keys, texts)
                keys, texts, held = [], [], 0
    if texts:
        yield _count_texts(keys, texts)


def shares(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / size) in whole numbers: long division by three digits at a time, so nothing overflows."""
    out, rest = np.zeros_like(counts), counts + 1
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, size)
        out = out * 1000 + digit
    return out + 1


def _pair_sums(sources: dict[str, tuple[list[str], np.ndarray]]):
    """(lang, source, item, value): for every two sources the sum over some terms; ``sources`` has each language's, with their sizes."""

    def add(lang: str, lists: pa.ListArray, sums: dict[str, np.ndarray]) -> None:
        names, size = sources[lang]
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        column = pc.index_in(lists.flatten().field(0), value_set=pa.array(names, pa.string())).to_numpy()
        counts = np.zeros((len(lists), len(names)), np.int64)
        counts[row, column] = lists.flatten().field(1).to_numpy()
        share = shares(counts, size)
        total = sums.setdefault(lang, np.zeros((len(names), len(names)), np.int64))
        for k in range(len(names)):
            apart = share[:, k : k + 1] - share
            total[k] += (apart * apart // share).sum(axis=0)

    def rows_of(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in sums.items():
            names = sources[lang][0]
            for name, values in zip(names, total, strict=True):
                yield pa.record_batch({"lang": pa.array([lang] * len(names)), "source": pa.array([name] * len(names)), "item": pa.array(names), "value": pa.array(values)})

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                lists = batch.column(1).filter(pc.equal(batch.column(0), lang))
                step = max(4096, CELLS // len(sources[lang][0]))
                for k in range(0, len(lists), step):
                    add(lang, lists.slice(k, step), found)
        yield from rows_of(found)

    return sums


def _share(count: str, size: str) -> Column:
    return F.expr(f"1 + (cast({SCALE} AS decimal(10,0)) * cast({count} + 1 AS decimal(20,0))) div cast({size} AS decimal(20,0))")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, total and counts (source, n) of the terms in at least ``min_docs`` documents of their language."""
    counts = docs.select("lang", "source", "text").mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return kept.where(F.col("docs") >= min_docs).select("lang", "term", "total", "counts")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank (see the module) for ``docs`` (text, lang, source)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = land(kept_terms(docs, min_docs), "audit-terms")
    uses = kept.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "c.source", "term", "c.n", "total")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), (F.sum("total") + F.count("*")).alias("lang_size"))
    groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(uses.groupBy("lang", "source").agg(F.sum("n").alias("words")), ["lang", "source"], "left")
    groups = land(groups.select("lang", "source", F.coalesce("kept", F.lit(0)).alias("kept"), "lang_size", (F.coalesce("words", F.lit(0)) + F.col("kept")).alias("size")), "audit-groups")
    pairs, terms = _pairs(kept, groups), _terms(uses, groups, top)
    return pairs.unionByName(terms)


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Every pair of sources of a language, ranked for the first."""
    sources: dict[str, tuple[list[str], list[int]]] = {}
    for r in groups.where("kept > 0").orderBy("lang", "source").collect():  # a row a source
        names, sizes = sources.setdefault(r.lang, ([], []))
        names.append(r.source)
        sizes.append(r.size)
    tables = {lang: (names, np.array(sizes, np.int64)) for lang, (names, sizes) in sources.items()}
    sums = kept.select("lang", "counts").mapInArrow(_pair_sums(tables), "lang string, source string, item string, value long")
    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    found = every.unionByName(sums).where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(uses: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms that set a source apart from its language, ranked by cells."""
    cells = uses.groupBy("lang", "source", "n", "total").agg(F.count("*").alias("terms")).join(groups, ["lang", "source"])
    cells = cells.withColumn("p", _share("n", "size")).withColumn("q", _share("total", "lang_size")).where("p > q")
    cells = land(cells.select("lang", "source", "n", "total", "terms", F.expr("((p - q) * (p - q)) div q").alias("value")), "audit-cells")
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = values.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("terms").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    chosen = cells.join(values, ["lang", "source", "value"]).select("lang", "source", "n", "total", "value", "before")
    found = uses.join(chosen, ["lang", "source", "n", "total"])
    order = Window.partitionBy("lang", "source", "value").orderBy("term")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    rank = (F.col("before") + F.col("place")).cast("int")
    return found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.alias("rank")).where(F.col("rank") <= top)


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all sources, and the 200 terms that set each apart most."""
    return audit(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS words FROM kept GROUP BY lang
), uses AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT g.lang, g.source, coalesce(sum(u.n), 0) AS words FROM groups g LEFT JOIN uses u ON g.lang = u.lang AND g.source = u.source GROUP BY ALL
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(u.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(u.n, 0) + 1)) // (CAST(s.words AS HUGEINT) + l.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.total + 1)) // (CAST(l.words AS HUGEINT) + l.v) AS q
  FROM sizes s JOIN langs l ON s.lang = l.lang JOIN kept k ON k.lang = s.lang
  LEFT JOIN uses u ON u.lang = s.lang AND u.source = s.source AND u.term = k.term
), sums AS (
  SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
