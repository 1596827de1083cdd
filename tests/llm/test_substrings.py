"""Substring deduplication against brute force."""

import hashlib
import random
import re
import sys

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import substrings  # noqa: E402

SF = "/root/testdata/sf0.01"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window=13):
    """(doc_id, n_words, n_removed, digest) of every row."""
    first = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w, gone = words_of(text), set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain(rows)
    assert got(substrings.op10_substrings(spark, SF)) == want
    assert sum(w[2] for w in want) > 1000


def passages(n=300):
    rng = random.Random(6)
    shared = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 50)) for _ in range(rng.randint(13, 70))) for _ in range(12)]
    rows = []
    for k in range(n):
        body = [" ".join(rng.choice("klmnop") + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 40))) for _ in range(3)]
        if k % 3 == 0:
            body.insert(1, shared[0] + "\n" + shared[k % 12])
        rows.append((rng.randint(0, 200), " ".join(body)))
    return rows + [(5, "same same " * 40), (6, "same same " * 40), (6, "same same " * 40)]


def test_groups_of_any_size_give_the_same(spark, monkeypatch):
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain(rows)
    assert got(substrings.report(df)) == want
    assert got(substrings.report(df, group_suffixes=60)) == want
    monkeypatch.setattr(substrings, "REDUCE_BYTES", 500)
    assert got(substrings.report(df, group_suffixes=500)) == want
    assert got(substrings.report(df, window=4)) == plain(rows, 4)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert got(substrings.report(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert substrings.report(no_documents(spark)).count() == 0
    clean = substrings.deduplicated(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert substrings.deduplicated(no_documents(spark)).count() == 0


def test_deduplicated_texts_and_maximal_repeats(spark):
    rng = random.Random(2)
    w = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    a, b, c = w(20), w(50), w(15)
    rows = [(1, " ".join(a + b + c)), (2, " ".join(w(9) + b[:30] + w(4) + c + w(3))), (3, "untouched  text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = sorted((r.doc_id, r.start, r.end) for r in substrings.maximal_repeats(df).collect())
    assert spans == [(2, 9, 39), (2, 43, 58)]
    out = {r.doc_id: r.text for r in substrings.deduplicated(df).collect()}
    words = rows[1][1].split()
    assert out[1] == rows[0][1] and out[3] == rows[2][1] and out[2].split() == words[:9] + words[39:43] + words[58:]


def test_prefix_groups_are_bounded_and_meet():
    import numpy as np

    rng = np.random.default_rng(1)
    words = [str(x).encode() for x in np.minimum(rng.geometric(0.3, 20_000), 40)]
    batch = substrings.Batch([words], 13)
    bins = 256
    counts = np.stack([np.bincount(x[batch.at], minlength=bins) for x in substrings.prefix_bins(batch.hashes, 13, bins)])
    groups = substrings.Groups(counts, 13, 500)
    of = groups.of(batch)
    codes = substrings.prefix_hashes(batch.hashes, [13])[0]
    assert groups.groups == 40 and all(len(set(of[codes == c].tolist())) == 1 for c in np.unique(codes)[:200])
    assert not groups.small[0].all() and np.bincount(of).max() <= 3000
