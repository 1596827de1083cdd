"""SimHash fingerprints and components against brute force."""

import re
import sys

import numpy as np
import xxhash

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import simhash  # noqa: E402
from tidesync.llm.components import components  # noqa: E402

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text, shingle=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, max_bits=4):
    """value -> least value reachable."""
    values = sorted(set(values))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def check(rows, texts_of):
    prints = {t: plain_fingerprint(t) for t in set(texts_of.values())}
    assert all(int(r.fingerprint, 16) == prints[texts_of[r.doc_id]] for r in rows)
    group = plain_components(prints.values())
    least = {}
    for i, t in texts_of.items():
        k = group[prints[t]]
        least[k] = min(least.get(k, i), i)
    assert all(r.component_id == least[group[prints[texts_of[r.doc_id]]]] for r in rows)


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = simhash.op2_simhash(spark, SF).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    assert len({r.component_id for r in rows}) < len(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = simhash.classes(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[3].fp == by_id[4].fp == by_id[5].fp == 0 and by_id[5].component_id == 3
    assert by_id[1].component_id == by_id[2].component_id == by_id[9].component_id == 1
    assert {r.component_id for r in rows if r.doc_id is None} == {1, 3}
    assert simhash.classes(no_documents(spark)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 6, 7, 8, 10] and kept.where("doc_id IS NULL").count() == 2
    only_nulls = docs.where("doc_id IS NULL")
    assert {r.component_id for r in simhash.classes(only_nulls).collect()} == {None}


def test_links_at_every_distance_and_in_hot_buckets(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = {int(x) for x in rng.integers(0, 1 << 63, 40)}
    for v in list(values):  # neighbours 1 to 6 bits away, and a dense ball
        for d in range(1, 7):
            values.add(v ^ sum(1 << int(b) for b in rng.choice(63, d, replace=False)))
    base = int(rng.integers(0, 1 << 63))
    values |= {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (600, 2))}
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    want = plain_components(values)
    for tile in (simhash.TILE, 40):
        monkeypatch.setattr(simhash, "TILE", tile)
        found = {r.node: r.root for r in components(simhash.links(df, 4)).collect()}
        assert {v: found.get(v, v) for v in values} == want


def test_more_blocks_find_the_same_links(spark, monkeypatch):
    assert len(simhash.block_masks(10, 4)) == 15 and len(simhash.block_masks(10**9, 4)) == 35
    rng = np.random.default_rng(8)
    values = [int(x) for x in rng.integers(0, 1 << 63, 30)]
    values += [v ^ sum(1 << int(b) for b in rng.choice(63, 4, replace=False)) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    masks = simhash.block_masks(10**9, 4)
    monkeypatch.setattr(simhash, "block_masks", lambda n, bits: masks)
    found = {r.node: r.root for r in components(simhash.links(df, 4)).collect()}
    want = plain_components(values)
    assert {v: found.get(v, v) for v in values} == want


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components(chain).collect()} == {0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(5, 5)], "a long, b long")).count() == 0
