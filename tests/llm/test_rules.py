"""Quality rules against brute force."""

import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import rules  # noqa: E402

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_stats(text):
    text = text or ""
    words, lines, seen, dup = WORD.findall(text), text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
        seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def plain_kept(docs, share, least, left, most=rules.MAX_DOCS):
    """kept by (host, text), with the line rule in plain loops."""
    texts = {}
    for host, text in docs:
        texts.setdefault(host, set()).add(text or "")
    out = {}
    for host, ts in texts.items():
        met = Counter(n for t in ts for n in {rules.normalised(x) for x in t.split("\n") if WORD.search(x)})
        bad = {x for x, n in met.items() if n >= least and (n > share * len(ts) or n > most)}
        for t in ts:
            n, *_, failed = plain_stats(t)
            gone = sum(len(WORD.findall(x)) for x in t.split("\n") if WORD.search(x) and rules.normalised(x) in bad)
            out[host, t] = not failed and not (gone and n - gone < left * n)
    return out


def same(row, text):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == plain_stats(text)


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = rules.op7_quality_rules(spark, SF).collect()
    kept = plain_kept([(d.source, d.text) for d in docs.values()], rules.MAX_SHARE, rules.MIN_DOCS, rules.MIN_LEFT)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(same(r, docs[r.doc_id].text) for r in rows)
    assert all(r.kept == kept[docs[r.doc_id].source, docs[r.doc_id].text] for r in rows)


def boilerplate(spark):
    letters = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    long = " ".join(f"own{letters(k)}" for k in range(40))
    rows = [(k, f"Page {k} of the site menu is here for all of you now\n{long} {letters(k)}x" if k % 3 else f"page {k}  of the SITE menu is here for all of you now", "h" if k % 2 else None) for k in range(120)]
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], "doc_id long, text string, source string, removed string, k_host string, __s string")


def test_frequent_lines_go_and_depleted_documents_with_them(spark):
    docs = boilerplate(spark)
    texts = docs.collect()
    rows = rules.judge(docs).collect()
    kept = plain_kept([(d.source, d.text) for d in texts], rules.MAX_SHARE, rules.MIN_DOCS, rules.MIN_LEFT)
    assert {r.doc_id: r.kept for r in rows} == {d.doc_id: kept[d.source, d.text] for d in texts}
    assert {r.kept for r in rows} == {True, False} and all(r.n_lines_removed == 1 for r in rows)
    clean = rules.cleaned(docs).collect()
    assert {r.doc_id for r in clean} == {r.doc_id for r in rows if r.kept}
    assert all("menu" not in r.text and "owndj" in r.text for r in clean) and rules.cleaned(docs).columns == docs.columns


def test_lines_of_many_documents_go_on_a_large_host(spark, monkeypatch):
    """A line in under 5 % of a host's documents goes once it is in more than the absolute limit."""
    monkeypatch.setattr(rules, "MAX_DOCS", 12)
    letters = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    body = lambda k: " ".join(f"w{letters(k)}{letters(j)}" for j in range(12))
    rows = [(k, (f"read more of this\n{body(k)}" if k % 25 == 0 else f"follow us now\n{body(k)}" if k % 40 == 1 else body(k)), "host") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = {r.doc_id: r for r in rules.judge(docs).collect()}
    assert {i for i, r in judged.items() if r.n_lines_removed} == {k for k in range(400) if k % 25 == 0}  # in 16 texts; the other in 10
    kept = plain_kept([(s, t) for _, t, s in rows], rules.MAX_SHARE, rules.MIN_DOCS, rules.MIN_LEFT, 12)
    assert all(judged[i].kept == kept[s, t] for i, t, s in rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    rows = rules.judge(docs).collect()
    assert len(rows) == docs.count()
    ids = {i: t for i, t in texts if i is not None}
    assert all(same(r, ids[r.doc_id]) for r in rows if r.doc_id is not None)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words == 0)
    assert rules.judge(no_documents(spark)).count() == 0 and rules.cleaned(no_documents(spark)).count() == 0
    assert rules.cleaned(docs).columns == docs.columns


def test_repeated_windows():
    for text in ("a b c d e a b c d e", "a a a a a a a", "a b c d e f g", "x y " * 30, "a b c d e x a b c d e f a b c d e"):
        assert rules.repeated_words(text.encode().split()) == plain_stats(text)[4]
