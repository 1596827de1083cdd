"""Approximate nearest neighbours by balanced posting lists.

Index. A bounded sample of distinct vectors is cut by balanced two-way k-means
until the pieces are small; their means are the centroids of the posting lists
and are linked in a nearest-neighbour graph. Each vector goes to its nearest
list, and to further ones whose centroid is nearly as near (boundary vectors),
unless a list already chosen is nearer to that centroid than the vector is.

Search. A beam search over the centroid graph finds a query's nearest lists; of
these, lists whose distance exceeds a ratio of the nearest one's are pruned.
Number of lists and ratio are set from the sample, so that its exact neighbours
are covered. Queries meet lists by a join on the list; inside a task, inner
products of one chunk of queries with one chunk of a list are one matrix
product, and only the best of each query go on.

Inner product is turned into distance by one more dimension (the length that a
vector lacks to the longest one); scores are inner products of the original
vectors in double precision.

Copies of a vector are indexed once, with their ``k + 1`` least ids, which are
all that can be among anyone's ``k`` nearest. Long lists, and lists that many
queries want, are cut in chunks of ``CHUNK``. Centroids and graph are bounded
by the sample, a parameter, and are all that is broadcast.

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; rows with a null id neither;
repeated rows of one id count once, and an id
with several vectors is as near as its nearest one; fewer candidates than ``k`` give fewer
rows; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import land, ship, table

#: Distinct vectors that the index is fitted on, at most.
SAMPLE = 40_000
#: Vectors of a list, about, and sample vectors that a list needs.
LIST, LEAST_SAMPLE = 400, 8
REPLICAS, RATIO = 8, 1.25
DEGREE, CHUNK = 16, 4096
#: Share of exact neighbours of sample queries that the chosen lists must hold.
COVER, TRIAL = 0.96, 400
SEED = 5


@dataclass
class Index:
    """Centroids, the graph over them, and how far a search goes."""

    centroids: np.ndarray
    graph: np.ndarray
    longest: float
    probes: int = 1
    ratio: float = math.inf

    def lifted(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0.0, self.longest**2 - (vectors**2).sum(axis=1)))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def nearest(self, points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` nearest centroids of each point and their distances, by beam search over the graph."""
        parts = [self._beam(points[k : k + 1024], n) for k in range(0, len(points), 1024)]
        n = min(n, len(self.centroids))
        return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.empty((0, n), int), np.empty((0, n)))

    def _beam(self, points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        k = len(self.centroids)
        n, width = min(n, k), min(k, max(2 * n, 48))
        far = lambda ids: np.sqrt(np.maximum(0.0, ((self.centroids[ids] - points[:, None, :]) ** 2).sum(axis=2)))
        ids = np.tile(np.unique(np.linspace(0, k - 1, min(k, 16)).astype(np.int64)), (len(points), 1))
        dist, done = far(ids), np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(np.where(done, np.inf, dist), axis=1, kind="stable")[:, :4]
            open_ = ~np.take_along_axis(done, order, axis=1)
            if not open_.any():
                break
            np.put_along_axis(done, order, True, axis=1)
            fresh = self.graph[np.take_along_axis(ids, order, axis=1)].reshape(len(points), -1)
            fresh_dist = far(fresh)
            fresh_dist[(fresh[:, :, None] == ids[:, None, :]).any(axis=2) | ~np.repeat(open_, self.graph.shape[1], axis=1)] = np.inf
            again = np.argsort(fresh, axis=1, kind="stable")
            twice = np.zeros(fresh.shape, bool)
            by_id = np.take_along_axis(fresh, again, axis=1)
            np.put_along_axis(twice, again[:, 1:], by_id[:, 1:] == by_id[:, :-1], axis=1)
            fresh_dist[twice] = np.inf
            ids, dist = np.concatenate([ids, fresh], axis=1), np.concatenate([dist, fresh_dist], axis=1)
            done = np.concatenate([done, ~np.isfinite(fresh_dist)], axis=1)
            best = np.argsort(dist, axis=1, kind="stable")[:, :width]
            ids, dist, done = (np.take_along_axis(x, best, axis=1) for x in (ids, dist, done))
        best = np.argsort(dist, axis=1, kind="stable")[:, :n]
        return np.take_along_axis(ids, best, axis=1), np.take_along_axis(dist, best, axis=1)

    def homes(self, vectors: np.ndarray) -> list[list[int]]:
        """The lists each vector goes to: the nearest, and near ones in other directions."""
        out: list[list[int]] = []
        for a in range(0, len(vectors), 512):
            ids, dist = self.nearest(self.lifted(vectors[a : a + 512]), REPLICAS * 3)
            near = self.centroids[ids]
            square = (near**2).sum(axis=2)
            apart = square[:, :, None] + square[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
            chosen = np.zeros(ids.shape, bool)
            chosen[:, 0] = True
            for j in range(1, ids.shape[1]):
                own_way = (~chosen[:, :j] | (apart[:, j, :j] > dist[:, j, None] ** 2)).all(axis=1)
                chosen[:, j] = own_way & (dist[:, j] <= RATIO * dist[:, 0]) & (chosen.sum(axis=1) < REPLICAS)
            out.extend(row[c].tolist() for row, c in zip(ids, chosen, strict=True))
        return out

    def wanted(self, queries: np.ndarray) -> list[list[int]]:
        """The lists each query searches."""
        ids, dist = self.nearest(self.lifted(queries, query=True), self.probes)
        return [row[far <= self.ratio * far[0] + 1e-9].tolist() for row, far in zip(ids, dist, strict=True)]


def _halves(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which half of a balanced two-means cut each point is in (neither under 35 %)."""
    a, b = points[rng.choice(len(points), 2, replace=False)]
    for _ in range(8):
        side = ((points - a) ** 2).sum(axis=1) > ((points - b) ** 2).sum(axis=1)
        if side.all() or not side.any():
            break
        a, b = points[~side].mean(axis=0), points[side].mean(axis=0)
    along = points @ (b - a)
    edge = np.clip((a + b) @ (b - a) / 2, *np.quantile(along, [0.35, 0.65]))
    side = along > edge
    if side.all() or not side.any():
        side = np.arange(len(points)) % 2 == 1
    return side


def fit(sample: np.ndarray, longest: float, n_vectors: int, k: int) -> Index:
    """The index of a sample, for ``n_vectors`` distinct vectors in all; ``k`` neighbours set how far searches go."""
    rng = np.random.default_rng(SEED)
    index = Index(np.zeros((1, sample.shape[1] + 1)), np.zeros((1, 1), np.int64), longest)
    points = index.lifted(sample)
    lists = max(1, min(math.ceil(n_vectors / LIST), len(sample) // LEAST_SAMPLE))
    largest = max(1, math.ceil(len(sample) / lists))
    pieces, centroids = [points], []
    while pieces:
        piece = pieces.pop()
        if len(piece) <= largest or len(piece) < 2:
            centroids.append(piece.mean(axis=0) if len(piece) else np.zeros(points.shape[1]))
        else:
            side = _halves(piece, rng)
            pieces += [piece[side], piece[~side]]
    # Lifted vectors are all of one length, and so are the centroids: directions are what tells lists apart.
    index.centroids = np.array(centroids)
    index.centroids *= longest / np.maximum(np.linalg.norm(index.centroids, axis=1, keepdims=True), 1e-12)
    n = len(centroids)
    square = (index.centroids**2).sum(axis=1)
    graph = np.empty((n, min(n, DEGREE) + 4), np.int64)
    for a in range(0, n, 512):
        far = square[a : a + 512, None] + square - 2 * index.centroids[a : a + 512] @ index.centroids.T
        graph[a : a + 512, :-4] = np.argsort(far, axis=1, kind="stable")[:, : graph.shape[1] - 4]
    graph[:, -4:] = rng.integers(0, n, (n, 4))  # long links keep it in one piece
    index.graph = graph
    if n > 1:
        _reach(index, sample, k, rng)
    return index


def _reach(index: Index, sample: np.ndarray, k: int, rng: np.random.Generator) -> None:
    """Probes and ratio that cover the exact neighbours of some sample vectors."""
    # As many neighbours as of the whole table would fall in the sample, but some at least.
    trial = sample[rng.choice(len(sample), min(TRIAL, len(sample)), replace=False)]
    nth = min(k, len(sample) - 1)
    near = np.concatenate([np.argpartition(-(trial[a : a + 32] @ sample.T), nth, axis=1)[:, : k + 1] for a in range(0, len(trial), 32)])
    points = index.lifted(trial, query=True)
    square = (points**2).sum(axis=1)[:, None] + (index.centroids**2).sum(axis=1) - 2 * points @ index.centroids.T
    dist = np.sqrt(np.maximum(0.0, square))  # one product: all centroids of the few trial queries
    place = np.argsort(np.argsort(dist, axis=1, kind="stable"), axis=1)
    rank, ratio = [], []
    for q in range(len(trial)):
        for homes in index.homes(sample[near[q]]):
            at = homes[int(np.argmin(place[q][homes]))]
            rank.append(int(place[q][at]))
            ratio.append(dist[q][at] / max(dist[q].min(), 1e-12))
    index.probes = min(len(index.centroids), int(np.quantile(rank, COVER)) + 2)
    index.ratio = float(np.quantile(ratio, (1 + COVER) / 2)) + 1e-6


def _ended(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(-1, dims).astype(np.float64))


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part, of the commonest length."""
    found = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    found = found.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    sizes = found.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return found.where(F.size("v") == (sizes.dims if sizes else 0))


def _least_ids(rows: DataFrame, n: int) -> DataFrame:
    """(v, uid, vec_id): the ``n`` least ids of every distinct vector, ``uid`` being the least; first within salts, then over them."""
    rows = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    for keys in (["v", "salt"], ["v"]):
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))).where(F.col("r") <= n)
    uid = F.min("vec_id").over(Window.partitionBy("v"))
    return rows.select("v", uid.alias("uid"), "vec_id")


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, sample_rows: int = SAMPLE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of ``vectors`` to each of ``queries``, its own id excepted."""
    spark = vectors.sparkSession
    ship(spark)
    rows = land(valid_vectors(vectors, id_col, vec_col), "ann-rows")
    least = land(_least_ids(rows, k + 1), "ann-ids")
    distinct = least.where("uid = vec_id").select("uid", "v")
    size = distinct.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest"), F.max(F.size("v")).alias("dims")).first()
    asked = valid_vectors(queries, id_col, vec_col).distinct().withColumn("quid", F.min("vec_id").over(Window.partitionBy("v")))
    schema = "query_id long, rank int, vec_id long, score double"
    if not size.n:
        return spark.createDataFrame([], schema)
    dims = size.dims
    asked = land(asked.where(F.size("v") == dims), "ann-queries")
    sample = distinct.orderBy(F.xxhash64("uid"), "uid").limit(sample_rows).select("v").toArrow()["v"].combine_chunks()
    shared = spark.sparkContext.broadcast(fit(_matrix(sample, dims), math.sqrt(size.longest) * (1 + 1e-9), size.n, k))

    def listed(kind: str):
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    part = batch.slice(a, 4096)
                    lists = getattr(shared.value, kind)(_matrix(part.column(1), dims))
                    at = np.repeat(np.arange(part.num_rows), [len(x) for x in lists])
                    taken = part.take(pa.array(at))
                    yield pa.record_batch([pa.array([c for x in lists for c in x], pa.int32()), taken.column(0), taken.column(1)], names=["list", "id", "v"])

        return go

    kind = "list int, id long, v array<double>"
    postings = land(distinct.select("uid", "v").mapInArrow(listed("homes"), kind), "ann-postings")
    wanted = land(asked.where("vec_id = quid").select("quid", "v").mapInArrow(listed("wanted"), kind), "ann-wanted")
    # One row a list: as many as the bounded sample allows.
    chunks = lambda df, name: df.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias(name))
    plan = F.broadcast(land(chunks(postings, "p_n").join(chunks(wanted, "q_n"), "list"), "ann-chunks"))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = postings.join(plan, "list").withColumn("p", own("p_n")).withColumn("q", every("q_n")).select("list", "p", "q", "id", "v")
    right = wanted.join(plan, "list").withColumn("q", own("q_n")).withColumn("p", every("p_n")).select("list", "p", "q", "id", "v")

    def best(vs: pa.Table, qs: pa.Table) -> pa.Table:
        out: dict[str, list] = {"quid": [], "uids": [], "scores": []}
        if vs.num_rows and qs.num_rows:
            v, q = _matrix(vs["v"].combine_chunks(), dims), _matrix(qs["v"].combine_chunks(), dims)
            uid, quid = vs["id"].to_numpy(), qs["id"].to_numpy()
            n = min(k + 1, len(uid))
            for a in range(0, len(q), 512):
                scores = q[a : a + 512] @ v.T
                cut = -np.partition(-scores, n - 1, axis=1)[:, n - 1]
                r, c = np.nonzero(scores >= cut[:, None] - 1e-12)  # ties and rounding included
                exact = np.einsum("ij,ij->i", q[a : a + 512][r], v[c])
                ends = np.searchsorted(r, np.arange(len(scores) + 1)).tolist()
                for i, (x, y) in enumerate(zip(ends, ends[1:], strict=False)):
                    out["quid"].append(int(quid[a + i]))
                    out["uids"].append(uid[c[x:y]].astype("<i8").tobytes())
                    out["scores"].append(exact[x:y].astype("<f8").tobytes())
        return pa.table({"quid": pa.array(out["quid"], pa.int64()), "uids": pa.array(out["uids"], pa.binary()), "scores": pa.array(out["scores"], pa.binary())})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by query -> the best of each query over all the lists it searched."""
        held: list[pa.RecordBatch] = []
        for batch in _ended(batches):
            if batch is not None and batch.num_rows:
                held.append(batch)
            if not held or (batch is not None and held[0].column(0)[0] == held[-1].column(0)[-1]):
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            quid = rows["quid"].to_numpy()
            stop = len(quid) if batch is None else int(np.searchsorted(quid, quid[-1]))
            held = [] if batch is None else rows.slice(stop).to_batches()
            part = rows.slice(0, stop)
            sizes = np.array([len(x) // 8 for x in part["uids"].to_pylist()], np.int64)
            q = np.repeat(quid[:stop], sizes)
            uid = np.frombuffer(b"".join(part["uids"].to_pylist()), "<i8")
            score = np.frombuffer(b"".join(part["scores"].to_pylist()), "<f8")
            order = np.lexsort((score, uid, q))[::-1]  # a vector met in several lists counts once
            q, uid, score = q[order], uid[order], score[order]
            once = np.ones(len(q), bool)
            once[1:] = (q[1:] != q[:-1]) | (uid[1:] != uid[:-1])
            q, uid, score = q[once], uid[once], score[once]
            order = np.lexsort((uid, -score, q))
            q, uid, score = q[order], uid[order], score[order]
            first = np.searchsorted(q, q)
            top = np.arange(len(q)) - first <= k
            yield pa.record_batch({"quid": q[top], "uid": uid[top], "score": score[top]})

    keys = ["list", "p", "q"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "quid long, uids binary, scores binary")
    found = found.repartition("quid").sortWithinPartitions("quid").mapInArrow(merged, "quid long, uid long, score double")
    found = land(found, "ann-found")
    ids = found.join(least.select("uid", "vec_id"), "uid")
    top = F.row_number().over(Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id"))
    ids = ids.withColumn("r", top).where(F.col("r") <= k + 1).select("quid", "vec_id", "score")
    answers = asked.select("quid", F.col("vec_id").alias("query_id")).join(ids, "quid").where("query_id <> vec_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))
