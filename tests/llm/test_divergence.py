"""The source audit against plain Python with whole numbers of any size."""

import re
import sys
from collections import Counter, defaultdict

import numpy as np

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import divergence  # noqa: E402

SF = "/root/testdata/sf0.01"


def plain(rows, min_docs=3, top=200):
    lower = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    counts, totals, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        counts[lang, source].update(terms)
        totals[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for (lang, source), own in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        p, q = share(own), share(totals[lang])
        f = lambda a, b: (a - b) * (a - b) // b
        parts = {"pair": [(-sum(f(p[t], r[t]) for t in kept), o) for (x, o), c in counts.items() if x == lang and o != source for r in [share(c)]]}
        parts["term"] = [(-f(p[t], q[t]), t) for t in kept if own[t] and p[t] > q[t]]
        for part, found in parts.items():
            found = sorted((v, item.encode()) for v, item in found)
            out += [(lang, source, part, item.decode(), -v, k) for k, (v, item) in enumerate(found if part == "pair" else found[:top], 1)]
    return sorted(out)


def same(docs, **settings):
    got = sorted(tuple(r) for r in divergence.audit(docs, **settings).select("lang", "source", "part", "item", "value", "rank").collect())
    want = plain([(r.text, r.lang, r.source) for r in docs.collect()], **settings)
    assert got == want
    return got


def test_odd_rows(spark):
    found = same(odd_documents(spark))
    assert {r[1] for r in found} == {"", "a"} and {r[0] for r in found} == {"en"}
    assert divergence.audit(no_documents(spark)).count() == 0


def test_random_words_with_ties(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = np.array(["a", "B", "b", "é", "漢字", "z-z", "Ärger", "x1y", "zz", "\U0001f642", "q'r"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)])
    rows = []
    for k in range(300):
        size = int(rng.integers(0, 60))
        rows.append((" ".join(words[(rng.pareto(0.6, size) * 3).astype(int) % len(words)]), [None, "en", "", "de"][k % 4], [None, "s1", "s2", "sé", "one"][int(rng.integers(0, 5))]))
    rows += [(None, "fr", "x"), ("lone words here", "fr", "y"), ("", "it", None)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    found = same(docs)
    assert {(r[4], r[5]) for r in found if r[0] == "fr"} == {(0, 1)} and not [r for r in found if r[0] == "it"]
    same(docs, min_docs=1, top=7)
    monkeypatch.setattr(divergence, "BLOCK", 200)  # many partial counts, and texts longer than a block
    same(docs, min_docs=2, top=3)


def test_ranks_of_more_equal_terms_than_asked_for(spark):
    words = [f"t{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(20)]
    rows = [(" ".join(words), "en", "s")] * 2 + [(" ".join(words[::-1]), "en", "s"), *[("common other", "en", "r")] * 3]
    found = same(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert [r[3] for r in sorted(found, key=lambda r: r[5]) if r[2] == "term" and r[1] == "s"] == sorted(words)[:200]


def test_shares_are_exact_for_large_counts():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 9 * 10**15, 200)
    counts = (size * rng.random(200)).astype(np.int64).clip(max=size - 1)
    want = [1 + 10**9 * (int(c) + 1) // int(s) for c, s in zip(counts, size, strict=True)]
    assert divergence.shares(counts, size).tolist() == want
