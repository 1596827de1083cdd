"""Nearest neighbours: recall and exact scores against brute force."""

import time

import numpy as np
import pytest

from tidesync.llm import neighbours

SF = "/root/testdata/sf0.1"


def plain(rows, k=20):
    """query id -> [(id, score)] over valid rows, exactly."""
    ids = [i for i, _ in rows]
    vectors = np.array([v for _, v in rows], float)
    out = {}
    for n, q in enumerate(ids):
        if q % 20 == 0:
            scores = vectors @ vectors[n]
            best = {}
            for i, s in zip(ids, scores.tolist(), strict=True):
                if i != q:
                    best[i] = max(best.get(i, -np.inf), s)
            out[q] = sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def answers(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = plain([(r.vec_id, r.embedding) for r in table])
    rows = neighbours.op8_neighbours(spark, SF).collect()
    got = answers(rows)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table}
    for r in rows:
        assert r.score == pytest.approx(vectors[r.query_id] @ vectors[r.vec_id], abs=1e-12)
    for v in got.values():
        assert v == sorted(v, key=lambda x: (-x[1], x[0]))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, list string, uid int, score double")


def test_ties_copies_and_unequal_lengths_of_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8)).astype(np.float32)
    rows = [(k, base[k % 60].tolist()) for k in range(400)]  # copies of every vector, so ties decide
    rows += [(1000 + k, (3 * base[k]).tolist()) for k in range(20)] + [(1040, base[0].tolist())] * 30
    got = answers(neighbours.search(frame(spark, rows), frame(spark, rows).where("vec_id % 20 = 0")).collect())
    want = plain(list(dict((i, (i, v)) for i, v in rows).values()))
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_one_vector_held_by_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 16)
    rng = np.random.default_rng(5)
    rows = [(k, [1.0, 0.5, 0.0, 0.25]) if k % 3 == 0 else (k, rng.normal(size=4).astype(np.float32).tolist()) for k in range(900)]
    got = answers(neighbours.search(frame(spark, rows), frame(spark, rows).where("vec_id % 20 = 0")).collect())
    want = plain(rows)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    assert [i for i, _ in got[0]] == [3 * k for k in range(1, 21)] or got[0][0][1] >= want[0][0][1] - 1e-9


def test_odd_vectors_take_no_part(spark):
    good = [(k, [float(k % 7) + 1, 2.0, -float(k % 3)]) for k in range(15)]
    odd = [(20, None), (40, [0.0, 0.0, 0.0]), (60, [1.0, None, 2.0]), (80, [1.0, float("nan"), 0.0]), (100, [float("inf"), 1.0, 1.0]), (120, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (140, [])]
    df = frame(spark, good + odd)
    got = answers(neighbours.search(df, df.where("vec_id % 20 = 0")).collect())
    assert got.keys() == {0} and [i for i, _ in got[0]] == [i for i, _ in plain(good)[0]] and len(got[0]) == 14
    assert neighbours.search(df.where("false"), df).count() == 0
    assert neighbours.search(df, df.where("false")).count() == 0
    one = frame(spark, [(20, [1.0, 2.0])])
    assert neighbours.search(one, one).count() == 0


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(4000, 16))
    index = neighbours.fit(sample, float(np.sqrt((sample**2).sum(axis=1).max())), 100_000, 10)
    assert len(index.centroids) > 100
    points = index.lifted(sample[:200], query=True)
    ids, dist = index.nearest(points, 10)
    exact = np.sqrt(((points[:, None] - index.centroids[None]) ** 2).sum(axis=2))
    want = np.argsort(exact, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), want.tolist(), strict=True)]) > 0.95
    homes = index.homes(sample[:500])
    assert all(1 <= len(h) <= neighbours.REPLICAS == len(set(h)) + neighbours.REPLICAS - len(h) for h in homes) and max(map(len, homes)) > 1


def clustered(n, dims=64, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(300, dims))
    return centres[rng.integers(0, 300, n)] + 0.7 * rng.normal(size=(n, dims))


def test_many_lists_are_fitted_soon_and_reached(spark):
    """At the cap of the sample's lists the fit ends soon; with some hundred lists, few of the vectors are read and most neighbours found."""
    x = clustered(40_000)
    longest = float(np.linalg.norm(x, axis=1).max())
    began = time.time()
    index = neighbours.fit(x, longest, 2_000_000, 20)
    assert len(index.centroids) > 3000 and time.time() - began < 150  # 27 s by itself
    index = neighbours.fit(x[:20_000], longest, 20_000, 20)
    homes = index.homes(x[:20_000])
    lists = [[] for _ in index.centroids]
    for i, own in enumerate(homes):
        for h in own:
            lists[h].append(i)
    asked, found, read = range(0, 20_000, 200), 0, 0
    for q, wanted in zip(asked, index.wanted(x[list(asked)]), strict=True):
        met = {i for h in wanted for i in lists[h]}
        score = x[:20_000] @ x[q]
        score[q] = -np.inf
        found += len(met & set(np.argsort(-score)[:20].tolist()))
        read += len(met)
    assert found >= 0.9 * 20 * len(asked) and read < 0.25 * 20_000 * len(asked)
