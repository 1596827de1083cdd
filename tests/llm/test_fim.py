"""Fill-in-middle: cuts and forms against plain Python, and the exact text back."""

import hashlib
import re
import sys

import pytest
import regex

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import LONG, no_documents, odd_documents  # noqa: E402

from tidesync.llm import fim  # noqa: E402

SF = "/root/testdata/sf0.01"


def plain(doc_id, text):
    """n, form, prefix_chars, middle_chars and output by a loop over single matches."""
    text = text or ""
    ends = [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    n, digest = len(ends), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted(([0] + ends)[x % (n + 1)] for x in h[:2])
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def same(docs):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = fim.fill_in_middle(docs).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in rows), key=key)
    assert got == sorted(((i, *plain(i, t), t or "") for i, t in texts), key=key)
    return rows


def test_whole_table(spark):
    rows = same(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    query = {r.doc_id: r for r in fim.op13_fill_in_middle(spark, SF).collect()}
    for r in rows:
        q = query[r.doc_id]
        assert (q.n, q.form, q.prefix_chars, q.middle_chars) == (r.n, r.form, r.prefix_chars, r.middle_chars)
        assert q.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() and q.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()


def test_odd_rows(spark):
    rows = same(odd_documents(spark))
    assert {r.form for r in rows if r.doc_id in (3, 4)} == {"plain"}
    assert fim.fill_in_middle(no_documents(spark)).count() == 0


def test_sentinels_in_and_near_texts(spark):
    parts = ["<", "<P", "<S", "<M", ">", "P>", "<P>", "<S>", "<M>", "a<", "\n", "é🙂", "ab"]
    texts = [a + b + c for a in parts for b in parts for c in parts]
    rows = same(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert all(r.form == "plain" for r in rows if any(s in texts[r.doc_id] for s in fim.SENTINELS))


def test_one_match_keeps_every_repetition():
    for text in ("", "a", " ", "ab  cd\n\x00é漢🙂z", LONG, "x" * 300_000, "1" * 300_000):
        assert fim.ends_of(text) == [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    with pytest.raises(ValueError):
        fim.ends_of("a b", regex.escape("a"))


def test_other_units_sentinels_and_rates(spark):
    docs = spark.createDataFrame([(k, f"one two {k} three") for k in range(200)], "key long, body string")
    rows = fim.fill_in_middle(docs, "key", "body", unit=r"[0-9]++|[^0-9]", sentinels=("[pre]", "[suf]", "[mid]"), rate=100, suffix_first=50).collect()
    assert {r.form for r in rows} == {"psm", "spm"} and all(r.restored == f"one two {r.doc_id} three" for r in rows)
    assert all(r.output.startswith("[pre]" if r.form == "psm" else "[suf]") for r in rows)
