"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

Features are indicators (present or not) of n-grams over three alphabets:
bytes (3-grams), words (1- and 2-grams) and word patterns (3-grams of each
word's shape, and of which of three neighbouring words are equal). Each is
hashed to one of ``2**bits`` columns.

1. Column counts per class over *all* labelled rows: each task sums its rows
   in two arrays and emits one row per column it met, so the shuffle carries
   at most ``2**bits`` rows a task. The log-count ratio of a column is the
   naive Bayes weight by which its indicator is scaled.
2. A linear hinge-loss model on the scaled indicators (rows of unit length) by
   dual coordinate descent. It is fitted on at most ``SAMPLE_ROWS`` labelled
   rows (those least by a hash of their id), part of which calibrates margins
   to probabilities. The sample's packed columns are the only rows that reach
   the driver, and the bound is fixed.
3. Scoring is a column expression: rows stay where they are read. What is sent
   to the tasks is one weight for each column, a constant size.

Neither ids, labels, languages nor sources enter a score.

Defined cases: null and empty texts score alike (the intercept alone); a null
label, or a label other than 0 and 1, is not learned from; repeated labelled
rows count as often as they occur; without labelled rows of both classes every
score is the share of label 1 (0.5 without any label); an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identified, ship, table

BITS = 18
#: Labelled rows that the linear model is fitted on, at most.
SAMPLE_ROWS = 8_000
#: Of these, the share that calibrates.
CALIBRATION = 0.25
ALPHA, C, EPOCHS = 1.0, 1.0, 12
THRESHOLD = 0.7
#: Text bytes whose n-grams are found at once; longer texts go piece by piece, whole.
PIECE = 1 << 20

_SHAPES = bytes((1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 or b >= 128 else 3 if 48 <= b <= 57 else b) for b in range(256))


def _columns(grams: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """Columns of 64-bit n-gram codes (multiply-shift hashing)."""
    mixed = (grams.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int32)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """The distinct columns of a text, ascending."""
    raw = (text or "").encode()
    found = []
    codes = np.frombuffer(raw, np.uint8)
    for k in range(0, len(codes), PIECE):
        b = codes[k : k + PIECE + 2].astype(np.uint32)
        if len(b) >= 3:
            found.append(_columns(np.unique(b[:-2] << 16 | b[1:-1] << 8 | b[2:]), 1, bits))
    words = raw.split()
    if words:
        w = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        shape = np.fromiter((zlib.crc32(x[:1].translate(_SHAPES) + x[1:2].translate(_SHAPES) + x[-2:].translate(_SHAPES)) for x in words), np.uint64, len(words))
        found += [_columns(w, 2, bits), _columns(shape, 3, bits)]
        if len(words) > 1:
            found.append(_columns(w[:-1] * np.uint64(0x100000001) ^ w[1:], 4, bits))
        if len(words) > 2:
            found.append(_columns((shape[:-2] * np.uint64(31) + shape[1:-1]) * np.uint64(31) + shape[2:], 5, bits))
            equal = (w[:-2] == w[1:-1]) + 2 * (w[1:-1] == w[2:]) + 4 * (w[:-2] == w[2:])
            found.append(_columns(equal.astype(np.uint64), 6, bits))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int32)


@dataclass(frozen=True)
class Model:
    """Weights on raw indicators (log-count ratios included), squared ratios for the row length, and the calibration."""

    weight: np.ndarray
    square: np.ndarray
    intercept: float
    slope: float
    offset: float
    bits: int

    def score(self, text: str | None) -> float:
        columns = features(text, self.bits)
        length = float(np.sqrt(self.square[columns].sum())) or 1.0
        margin = float(self.weight[columns].sum()) / length + self.intercept
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def column_counts(labelled: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of label 1 and of label 0 that have each column, over all of ``labelled`` (text, label)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[label][features(text, bits)] += 1
        met = np.nonzero(sums.any(axis=0))[0]
        for k in range(0, len(met), 10_000):
            part = met[k : k + 10_000]
            yield pa.record_batch({"column": part.astype(np.int32), "zero": sums[0][part], "one": sums[1][part]})

    rows = labelled.select("text", F.col("label").cast("int")).mapInArrow(count, "column int, zero long, one long")
    total = rows.groupBy("column").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toArrow()
    counts = np.zeros((2, 1 << bits))
    at = total["column"].to_numpy()
    counts[0][at], counts[1][at] = total["zero"].to_numpy(), total["one"].to_numpy()
    return counts[1], counts[0]


def dual_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, c: float = C, epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over ratio-scaled rows of unit length (and an intercept) by dual coordinate descent."""
    square = np.array([float(ratio[r] @ ratio[r]) for r in rows])
    scale = 1.0 / np.sqrt(np.where(square > 0, square, 1.0))  # rows stay indicators; their values are made as they are needed
    w, b, alpha, rng = np.zeros(len(ratio)), 0.0, np.zeros(len(y)), np.random.default_rng(seed)
    diagonal = square * scale**2 + 1.0
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            value = ratio[rows[i]] * scale[i]
            gradient = y[i] * (w[rows[i]] @ value + b) - 1.0
            step = min(max(alpha[i] - gradient / diagonal[i], 0.0), c) - alpha[i]
            if step:
                alpha[i] += step
                w[rows[i]] += step * y[i] * value
                b += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, b


def calibrate(margin: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins (Newton steps, slightly shrunk)."""
    target = np.where(label == 1, (label.sum() + 1) / (label.sum() + 2), 1 / (len(label) - label.sum() + 2))
    x, theta = np.stack([margin, np.ones(len(margin))], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0]))
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model learned from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1)."""
    ship(docs.sparkSession)
    labels = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("label").cast("int").alias("label"))
    # The same plan at every size: texts are shuffled once, never behind a broadcast that depends on the labels' number.
    labelled = docs.join(labels.hint("merge"), "doc_id").select("text", "label")
    one, zero = column_counts(labelled, bits)
    p, q = one + ALPHA, zero + ALPHA
    ratio = np.log((p / p.sum()) / (q / q.sum()))

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([features(t, bits).tobytes() for t in texts.to_pylist()], pa.binary())

    # A fixed number of labelled ids, whatever the size of the corpus: small enough to send to every task.
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", packed("text").alias("columns")).toArrow()
    order = np.lexsort((sample["label"].to_numpy(), sample["doc_id"].to_numpy()))
    label = sample["label"].to_numpy()[order]
    rows = [np.frombuffer(sample["columns"][int(i)].as_buffer(), np.int32) for i in order]
    share = (label.sum() + 1) / (len(label) + 2) if len(label) else 0.5
    if len(set(label.tolist())) < 2:
        flat = np.zeros(1 << bits)
        return Model(flat, flat, 0.0, 1.0, float(np.log(share / (1 - share))), bits)
    held = np.random.default_rng(11).random(len(label)) < CALIBRATION
    if len(set(label[held].tolist())) < 2 or len(set(label[~held].tolist())) < 2:
        held[:] = False
    y = np.where(label == 1, 1.0, -1.0)
    w, b = dual_descent([r for r, h in zip(rows, held, strict=True) if not h], ratio, y[~held])
    weight, square = w * ratio, ratio * ratio
    apart = held if held.any() else ~held
    margin = np.array([weight[r].sum() / (np.sqrt(square[r].sum()) or 1.0) + b for r, h in zip(rows, apart, strict=True) if h])
    slope, offset = calibrate(margin, label[apart])
    return Model(weight, square, b, slope, offset, bits)


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """Scores in 0 to 1 of a text column."""
    shared = spark.sparkContext.broadcast(model)  # two weights a column: 4 MB at 18 bits, whatever the input

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shared.value.score(t) for t in texts.to_pylist()], pa.float64())

    return scores(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id's text has remainder 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The model from ``docs`` and the quality labels of rows that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return fit(identified(docs, "doc_id", "text").where(~held_out()), labels.where(~held_out()))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score and class."""
    docs = table(spark, sf_dir, "documents")
    model = learned(spark, docs, sf_dir)
    scored = identified(docs, "doc_id", "text").select("doc_id", held_out().alias("held_out"), score(F.col("text"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the rows that score under the threshold."""
    model = learned(spark, docs, sf_dir)
    return docs.where(score(F.col("text"), model, spark) >= THRESHOLD)
