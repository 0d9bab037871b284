"""Approximate nearest neighbours (operator 9): balanced posting lists.

Copies of a vector collapse to one entry with its smallest ids, as many as a
result can need. Centroids come from balanced bisection (each cut halves its
part) of a bounded sample of the distinct vectors; there are about one per
``list_rows`` vectors, ``MAX_LISTS`` at most. They are searched through an
in-memory neighbour graph (best first, all vectors of a batch in step). Every
vector is posted to its nearest centroid and, near a boundary, also to others
whose distance is within ``REPLICA_RATIO`` of the nearest, ``REPLICAS`` in all.
A query reads the lists whose centroid's distance is within ``query_ratio`` of
the nearest one's, and in any case the nearest ones that hold ``LEAST_READ``
times the rows asked for. Long lists are dealt out in blocks; a query meets all
blocks of a list. Distances to listed vectors are exact, in double precision.

Null vectors, those with a null or non-finite component, zero vectors and
those whose length isn't the commonest (the smaller of equals) take no part,
as queries or candidates. Equal distances fall to the smaller id. An id that
repeats is one vector for each distinct content; rows equal in both are one.
Rows with a null id take no part. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import written

SAMPLE = 32_768
MAX_LISTS = 4096
LIST_ROWS = 512
BLOCK_ROWS = 4096
REPLICAS = 4
REPLICA_RATIO = 1.1
QUERY_RATIO = 1.12
LEAST_READ = 100
GRAPH_DEGREE = 16
BEAM = 64


def bisect(points: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of ``lists`` equal parts: each cut runs along the line between
    two means and halves its part (by the share of lists on either side)."""
    out = []
    todo = [(np.arange(len(points)), lists)]
    while todo:
        own, n = todo.pop()
        x = points[own]
        if n <= 1 or len(own) <= 1:
            out.append(x.mean(0))
            continue
        mean = x.mean(0)
        a = x[((x - mean) ** 2).sum(1).argmax()]
        b = x[((x - a) ** 2).sum(1).argmax()]
        low = n // 2
        for _ in range(8):
            order = np.argsort(x @ (b - a), kind="stable")
            cut = round(len(own) * low / n)
            left, right = order[:cut], order[cut:]
            if not len(left) or not len(right):
                break
            a, b = x[left].mean(0), x[right].mean(0)
        todo += [(own[left], low), (own[right], n - low)] if len(left) and len(right) else [(own, 1)]
    return np.array(out)


class CentroidGraph:
    """Neighbour graph over centroids, searched best first."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        n = len(centroids)
        self.norm = (centroids**2).sum(1)
        degree = min(GRAPH_DEGREE, n - 1)
        links = np.zeros((n, degree + 2), np.int64)
        for at in range(0, n, 1024):
            d = self.norm - 2 * centroids[at:at + 1024] @ centroids.T
            d[np.arange(len(d)), np.arange(at, at + len(d))] = -np.inf
            links[at:at + 1024, :degree] = np.argpartition(d, degree, 1)[:, :degree + 1][:, :degree] if degree else 0
        links[:, -2], links[:, -1] = (np.arange(n) + 1) % n, (np.arange(n) - 1) % n  # a ring keeps it connected
        self.links = links
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 2 + int(n**0.5))).astype(np.int64))

    def distances(self, q: np.ndarray, which: np.ndarray) -> np.ndarray:
        return ((self.c[which] - q[:, None, :]) ** 2).sum(2)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query the nearest centroids found and squared distances, in order."""
        n, m = len(self.c), len(q)
        beam = min(beam, n)
        rows = np.arange(m)[:, None]
        seen = np.zeros((m, n), bool)
        ids = np.full((m, beam), n)
        dist = np.full((m, beam), np.inf)
        done = np.ones((m, beam), bool)
        offered, idle = np.tile(self.entries, (m, 1)), np.zeros((m, 1), bool)
        while True:
            new = ~seen[rows, offered] & ~idle
            seen[rows, offered] = True
            order = np.argsort(offered, 1, kind="stable")  # a node may be offered twice
            s = np.take_along_axis(offered, order, 1)
            again = np.zeros_like(new)
            np.put_along_axis(again, order[:, 1:], s[:, 1:] == s[:, :-1], 1)
            d = np.where(new & ~again, self.distances(q, offered), np.inf)
            every = np.concatenate([dist, d], 1)
            best = np.argsort(every, 1, kind="stable")[:, :beam]
            dist = np.take_along_axis(every, best, 1)
            ids = np.take_along_axis(np.concatenate([ids, np.where(np.isinf(d), n, offered)], 1), best, 1)
            done = np.take_along_axis(np.concatenate([done, np.isinf(d)], 1), best, 1)
            if done.all():
                return ids, dist
            at = np.argmin(done, 1)[:, None]  # the nearest node not yet expanded
            idle = np.take_along_axis(done, at, 1)
            np.put_along_axis(done, at, True, 1)
            offered = self.links[np.minimum(np.take_along_axis(ids, at, 1)[:, 0], n - 1)]

    def replicas(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every posting."""
        ids, d = self.search(x, 4 * REPLICAS)
        near = np.sqrt(d[:, :REPLICAS])
        keep = (near <= REPLICA_RATIO * near[:, :1]) & (ids[:, :REPLICAS] < len(self.c))
        row, rank = np.nonzero(keep)
        return row, ids[row, rank]

    def lists_for(self, q: np.ndarray, sizes: np.ndarray, ratio: float, rows: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that each query reads."""
        while True:  # a wider beam until it holds all lists within the ratio
            ids, d = self.search(q, beam)
            ok = ids < len(self.c)
            if beam >= len(self.c) or (np.sqrt(d[:, -1]) > ratio * np.sqrt(d[:, 0])).all():
                break
            beam *= 2
        size = np.where(ok, sizes[np.minimum(ids, len(self.c) - 1)], 0)
        before = np.cumsum(size, 1) - size
        read = ok & ((np.sqrt(d) <= ratio * np.sqrt(d[:, :1])) | (before < rows))
        row, at = np.nonzero(read)
        return row, ids[row, at]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return pa.concat_arrays([column]).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def usable(vector: str) -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (id, vec) -> vec, vid (its smallest id), ids (the k + 1 smallest)."""
    order = Window.partitionBy("vec").orderBy("id")
    first = rows.withColumn("place", F.dense_rank().over(order)).filter(F.col("place") <= k + 1)
    return first.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids")).select("vec", F.col("ids")[0].alias("vid"), "ids")


def fit_centroids(vectors: DataFrame, dim: int, lists: int, n: int, sample: int) -> np.ndarray:
    """Centroids of a sample of about ``sample`` distinct vectors, from one task."""
    share = int(min(1.0, sample / max(1, n)) * (1 << 40))
    drawn = vectors.filter(F.shiftrightunsigned(F.xxhash64("vec"), 24) < share).select("vid", "vec").repartition(1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = [], []
        for batch in batches:
            ids.append(batch.column("vid").to_numpy())
            points.append(matrix(batch.column("vec"), dim))
        if points:
            points = np.concatenate(points)[np.argsort(np.concatenate(ids), kind="stable")]
            yield pa.RecordBatch.from_arrays([pa.array([bisect(points, lists).tobytes()], pa.binary())], names=["c"])

    got = drawn.mapInArrow(cut, "c binary").collect()
    return np.frombuffer(got[0].c).reshape(-1, dim) if got else vectors_mean(vectors, dim)


def vectors_mean(vectors: DataFrame, dim: int) -> np.ndarray:
    """One centroid, for tables so small that the sample came out empty."""
    one = vectors.orderBy("vid").limit(1).collect()
    return np.array([one[0].vec], np.float64) if one else np.zeros((1, dim))


def nearest_in_block(postings: pa.Table, queries: pa.Table, dim: int, k: int) -> pa.Table:
    """The k + 1 nearest ids of each query among a block's vectors."""
    out: list[tuple[int, int, float]] = []
    if len(postings) and len(queries):
        x, q = (matrix(t.column("vec").combine_chunks(), dim) for t in (postings, queries))
        ids = postings.column("ids").to_pylist()
        norm = (x**2).sum(1)
        for at in range(0, len(q), 256):
            part = q[at:at + 256]
            rough = norm - 2 * part @ x.T + (part**2).sum(1)[:, None]
            top = min(k, len(x) - 1)
            bound = np.partition(rough, top, 1)[:, top]
            bound = bound + 1e-9 * (np.abs(bound) + norm.max() + (part**2).sum(1))
            for i, vid in enumerate(queries.column("vid")[at:at + 256].to_pylist()):
                near = np.flatnonzero(rough[i] <= bound[i])
                d = np.sqrt(((x[near] - part[i]) ** 2).sum(1))
                found = sorted((float(s), v) for s, j in zip(d, near, strict=True) for v in ids[j])[:k + 1]
                out += [(vid, v, s) for s, v in found]
    vid, vec, score = zip(*out, strict=True) if out else ((), (), ())
    return pa.table([pa.array(vid, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())],
                    names=["vid", "vec_id", "score"])


def nearest(vectors: DataFrame, query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
            list_rows: int = LIST_ROWS, query_ratio: float = QUERY_RATIO, sample: int = SAMPLE, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which
    ``query`` (over the column ``id``) holds."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")).filter(
        F.col("id").isNotNull() & usable("vec"))
    common = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dim = common.d if common else 1
    rows = rows.filter(F.size("vec") == dim)
    distinct = written(distinct_vectors(rows, k), "vectors")
    n = distinct.count()
    graph = CentroidGraph(fit_centroids(distinct, dim, int(np.clip(n // list_rows, 1, MAX_LISTS)), n, sample))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2048):
                batch = whole.slice(at, 2048)
                row, own = graph.replicas(matrix(batch.column("vec"), dim))
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *taken.columns], names=["list", *taken.schema.names])

    kind = rows.schema["vec"].dataType.simpleString()
    postings = written(distinct.mapInArrow(post, f"list int, vec {kind}, vid long, ids array<long>"), "postings")
    sizes = np.zeros(len(graph.c), np.int64)
    for r in postings.groupBy("list").count().collect():  # a row a list
        sizes[r["list"]] = r["count"]
    blocks = np.maximum(1, -(-sizes // BLOCK_ROWS))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                row, own = graph.lists_for(matrix(batch.column("vec"), dim), sizes, query_ratio, LEAST_READ * k, beam)
                n_blocks = blocks[own]
                block = np.arange(n_blocks.sum()) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
                row, own = np.repeat(row, n_blocks), np.repeat(own, n_blocks)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(block.astype(np.int32)), *taken.columns],
                                                 names=["list", "block", *taken.schema.names])

    block_of = F.get(F.array(*[F.lit(int(b)) for b in blocks]), F.col("list")) if blocks.max() > 1 else F.lit(1)
    dealt = postings.withColumn("block", F.pmod(F.xxhash64("vid", "vec"), block_of).cast("int"))
    asked = rows.filter(query)
    queries = asked.select("vec").distinct().join(distinct.select("vec", "vid"), "vec")
    probes = queries.select("vec", "vid").mapInArrow(probe, f"list int, block int, vec {kind}, vid long")
    found = dealt.groupBy("list", "block").cogroup(probes.groupBy("list", "block")).applyInArrow(
        lambda p, q: nearest_in_block(p, q, dim, k), "vid long, vec_id long, score double")
    # ids of one vid have one content, unless an id repeats with several
    names = asked.distinct().join(distinct.select("vec", "vid"), "vec").select(F.col("id").alias("query_id"), "vid")
    best = Window.partitionBy("vid").orderBy("score", "vec_id")
    top = (found.groupBy("vid", "vec_id").agg(F.min("score").alias("score"))
           .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1))
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (names.join(top, "vid").filter("query_id <> vec_id").withColumn("rank", F.row_number().over(last))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
