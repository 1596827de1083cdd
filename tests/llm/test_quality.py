"""The quality classifier: held-out accuracy, and its parts by themselves."""

import sys
import zlib

import numpy as np

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import quality  # noqa: E402

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.op3_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [p for p, y in held if y == 1], [p for p, y in held if y == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.06


def test_odd_rows_and_missing_labels(spark):
    docs = odd_documents(spark)
    plain = docs.selectExpr("doc_id", "coalesce(text, '') AS text")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 7), (1, 1)], "doc_id long, label int")
    model = quality.fit(plain, labels)
    scores = docs.select("text", quality.score(docs["text"], model, spark).alias("s")).collect()
    assert len(scores) == docs.count() and all(0 <= r.s <= 1 for r in scores)
    empty = {r.s for r in scores if not (r.text or "").strip() and not r.text}
    assert len(empty) == 1
    for none in (labels.where("false"), labels.where("label = 1")):
        flat = quality.fit(plain, none)
        assert len({r[0] for r in docs.select(quality.score(docs["text"], flat, spark)).collect()}) == 1
    nothing = no_documents(spark)
    assert quality.fit(nothing.select("doc_id", "text"), labels).score("x") == 0.5
    assert nothing.where(quality.score(nothing["text"], model, spark) > 0).count() == 0


def test_counts_cover_all_rows_of_each_class(spark):
    texts = [("aa bb", 1), ("aa cc", 0), ("aa bb", 1), (None, 0)]
    one, zero = quality.column_counts(spark.createDataFrame(texts, "text string, label int"))
    want = np.zeros((2, 1 << quality.BITS))
    for t, y in texts:
        want[y][quality.features(t)] += 1
    assert (one == want[1]).all() and (zero == want[0]).all()


def test_dual_descent_separates_and_weighs_by_ratio():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])] * 5
    y = np.array([1.0, 1.0, -1.0, -1.0] * 5)
    w, b = quality.dual_descent(rows, np.array([1.0, 1.0, 0.01, 0.01]), y)
    margin = np.array([w[r].sum() + b for r in rows])
    assert (np.sign(margin) == y).all() and abs(w[2]) < abs(w[0])


def test_long_texts_are_scored_whole():
    text = "clean words of prose. " * 80_000
    tail = set(quality._columns(np.array([ord("~") << 16 | ord("z") << 8 | ord("~")], np.uint64), 1, quality.BITS).tolist())
    assert tail <= set(quality.features(text + "~z~").tolist())


def plain_hinge(x, y, c, steps=60_000):
    """Weights of the hinge loss with a regularised intercept, by projected gradient ascent on the dual over a dense matrix."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    gram = (y[:, None] * x) @ (y[:, None] * x).T
    alpha, rate = np.zeros(len(y)), 1.0 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(steps):
        alpha = np.clip(alpha + rate * (1 - gram @ alpha), 0, c)
    w = (alpha * y) @ x
    return w[:-1], w[-1]


def test_dual_descent_equals_a_plain_solver():
    """The same weights as another method gives on dense rows, also where the classes can't be separated."""
    rng = np.random.default_rng(21)
    ratio = rng.normal(size=30)
    rows = [np.unique(rng.integers(0, 30, int(rng.integers(1, 12)))) for _ in range(80)]
    dense = np.zeros((80, 30))
    for k, r in enumerate(rows):
        dense[k, r] = ratio[r] / np.linalg.norm(ratio[r])
    truth = rng.normal(size=30)
    y = np.where(dense @ truth + 0.3 * rng.normal(size=80) > 0, 1.0, -1.0)
    for c in (0.1, 1.0):
        w, b = quality.dual_descent(rows, ratio, y, c=c, epochs=2000)
        want, intercept = plain_hinge(dense, y, c)
        assert np.abs(w - want).max() < 0.02 and abs(b - intercept) < 0.02
        loss = lambda v, i: (v @ v + i * i) / 2 + c * np.maximum(0, 1 - y * (dense @ v + i)).sum()  # noqa: E731, B023
        assert loss(w, b) <= loss(want, intercept) * 1.001
    few = quality.dual_descent(rows, ratio, y)  # as many epochs as the fit takes
    want = plain_hinge(dense, y, quality.C)
    assert np.mean(np.sign(dense @ few[0] + few[1]) == np.sign(dense @ want[0] + want[1])) > 0.95
