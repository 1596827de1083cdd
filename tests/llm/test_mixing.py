"""Mixing: targets, whole documents near them, disjoint draws, locally shuffled shards."""

import collections
import re
import sys
from fractions import Fraction

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import mixing  # noqa: E402

SF = "/root/testdata/sf0.01"


def plain_targets(sizes, weights, limit=3):
    """The rule as it is stated, in small steps: what stands above the limit is cut and shared again."""
    fixed, total = {}, Fraction(sum(sizes))
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(fixed.values())
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free} if free else {}
        over = [i for i in free if share[i] > limit * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed.update({i: Fraction(limit * sizes[i]) for i in over})


@pytest.mark.parametrize("sizes", [[10, 100, 1000], [0, 5, 5], [1, 1, 1, 1000, 1000], [7], [0, 0]])
def test_targets(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert got == plain_targets(sizes, weights)
    assert sum(got) == sum(sizes) and all(t <= 3 * s for t, s in zip(got, sizes, strict=True))


def test_query_follows_its_contract(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = mixing.op4_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    names = sorted({d.source for d in docs.values()})
    totals = [sum(size[i] for i, d in docs.items() if d.source == s) for s in names]
    want = dict(zip(names, plain_targets(totals, [(5, 2, 1)[k % 3] for k in range(len(names))]), strict=True))
    taken = collections.Counter()
    for r in rows:
        s = docs[r.doc_id].source
        assert r["size"] == size[r.doc_id] and r.source_size == totals[names.index(s)] and r.target == float(want[s])
        assert 0 <= r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= max(5, 0.005 * want[s]) for s in names)
    again = mixing.shares(spark.read.parquet(f"{SF}/documents.parquet").repartition(7)).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in rows}


def test_mix_repeats_what_the_shares_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix(docs, shard_words=50_000)
    assert mixed.columns == docs.columns
    got = collections.Counter(r.doc_id for r in mixed.select("doc_id").collect())
    rows = mixing.shares(docs).collect()
    assert all(got.get(r.doc_id, 0) * r["size"] == r.taken for r in rows)
    order = [r.doc_id for r in mixed.select("doc_id").collect()]
    assert order != sorted(order)


def test_splitting_tree_keeps_quotas_and_balances_shards():
    quotas = [1000, 37, 0, 4021, 5]
    tree = mixing.split_tree(quotas, 13)
    assert tree.sum(axis=0).tolist() == quotas and tree.min() >= 0
    assert tree.sum(axis=1).max() - tree.sum(axis=1).min() <= 2
    assert (tree == mixing.split_tree(quotas, 13)).all()
    assert mixing.split_tree([0, 0], 4).sum() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 12, 1000])
def test_permutation(n):
    a, b = mixing.permutation(n, 3)
    assert sorted((a * k + b) % n for k in range(n)) == list(range(n))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixing.shares(docs).collect()
    assert len(rows) == docs.count()
    assert sum(r.taken for r in rows) == pytest.approx(sum(r["size"] for r in rows), rel=0.02)
    assert sorted({r.source_size for r in rows}) == sorted({r["s"] for r in docs.selectExpr("source", "coalesce(size(regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)), 0) AS n").groupBy("source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "s").collect()})
    assert mixing.mix(docs).columns == docs.columns
    nothing = no_documents(spark)
    assert mixing.shares(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    blank = docs.where("text IS NULL OR doc_id IN (4, 5)")
    assert {(r.target, r.taken) for r in mixing.shares(blank).collect()} == {(0.0, 0)}


def test_sum_of_a_hot_source_split_over_blocks(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', CAST(1 + id % 50 AS INT)) AS text", "IF(id % 3 = 0, 'hot', concat('s', id % 5)) AS source")
    made = mixing.Mix(docs)
    assert made.blocks.where("src = 0").count() >= 3
    rows = mixing.shares(docs).collect()
    taken = collections.Counter()
    for r in rows:
        taken[docs_source(r.doc_id)] += r.taken
    assert all(abs(taken[docs_source(r.doc_id)] - r.target) <= 5 for r in rows)


def docs_source(doc_id):
    return "hot" if doc_id % 3 == 0 else f"s{doc_id % 5}"


def test_taken_is_what_a_replay_of_tree_and_permutation_takes(spark):
    """Shard after shard deals the next draws of every source in plain Python; nothing else decides what is taken."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', CAST(1 + id % 37 AS INT)) AS text", "IF(id % 3 = 0, 'a', concat('s', id % 7)) AS source")
    made = mixing.Mix(docs, shard_words=9_000)
    assert len(made.tree) > 5
    block_of = {r.doc_id: (r.src, r.block) for r in made.sizes.select("doc_id", "src", "block").collect()}
    shards = collections.defaultdict(list)  # (source, block) -> the shards that take it
    for k in range(len(made.names)):
        n = made.n_blocks[k]
        a, b = mixing.permutation(n, k)
        at_place = {(a * block + b) % n: block for block in range(n)}
        draw = 0
        for shard, quota in enumerate(made.tree[:, k].tolist()):
            for _ in range(quota):
                shards[k, at_place[draw % n]].append(shard)
                draw += 1
        assert draw == made.epochs[k] * n + made.full[k]
    extra = {r.doc_id for r in made.extra.collect()}
    rows = {r.doc_id: r for r in mixing.shares(docs, shard_words=9_000).collect()}
    for i, r in rows.items():
        own = shards[block_of[i]] + [len(made.tree) - 1] * (i in extra)
        assert r.taken == r["size"] * len(own) and r.n_shards == len(set(own))
    in_shard = collections.Counter(s for i in rows for s in shards[block_of[i]])
    assert set(in_shard) == set(range(len(made.tree)))
