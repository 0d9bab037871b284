"""Ranks over packed adjacency blocks: PageRank in edge-flow (M8) and power-iteration
(M9) form and HITS (M10) for many rounds (J9).

Pages get dense numbers, and ``BLOCK_PAGES`` numbers in a row are a block. The edges that
leave a block are packed once, by destination block, into sorted arrays of 64-bit codes
(destination, source), 8 bytes an edge, and cached under ``(block, salt)``. Scores
are arrays too, one row a block. A round moves no edge:

* the cached edges meet their block's scores (a co-group under ``(block, salt)``; only
  scores are exchanged) and are summed per destination in the task;
* the sums, one packed row per (block, salt, destination block), are exchanged by
  destination block and added up row after row in a fixed order, so reruns agree.

A block's edges are salted by a hash of the destination into groups of at most about
``GROUP_EDGES`` edges; a page that holds a third of all edges is spread over as many groups,
and its block's scores are repeated once a group. A destination has at most
``BLOCK_PAGES`` edges from one block, so no group outgrows its bound by more than that.
What a task holds is a group's edges, or one block's scores. A round costs two stages
however small the graph is; for graphs that fit a broadcast, ``operators.graph`` is quicker.

Edges with a null end are left out; repeated edges and loops count once (U1). An empty
edge list gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.sequence import with_global_index
from lodestar.plans.iterate import LineageCutter

#: Pages of a block; a row of scores has as many doubles.
BLOCK_PAGES = 1 << 18

#: Edges of a group, on average at most; one task's array work.
GROUP_EDGES = 1 << 20

_LOW = (1 << 32) - 1
_PARTIAL = pa.schema([("db", pa.int32()), ("sb", pa.int32()), ("salt", pa.int32()),
                      ("d", pa.list_(pa.int32())), ("y", pa.list_(pa.float64()))])
_PARTIAL_SQL = "db int, sb int, salt int, d array<int>, y array<double>"


def _send(edges: pa.Table, scores: pa.Table) -> pa.Table:
    """Partial sums of one group: its edges beside its block's scores."""
    if not edges.num_rows or not scores.num_rows:
        return _PARTIAL.empty_table()
    x = scores.column("z")[0].values.to_numpy()
    out_d, out_y = [], []
    for cell in edges.column("e"):
        codes = cell.values.to_numpy()
        d = codes >> 32
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        out_d.append(d[first].astype(np.int32))
        out_y.append(np.add.reduceat(x[codes & _LOW], first))
    return pa.table([edges.column("db"), edges.column("sb"), edges.column("salt"),
                     pa.array(out_d, pa.list_(pa.int32())), pa.array(out_y, pa.list_(pa.float64()))],
                    schema=_PARTIAL)


class PackedGraph:
    """Distinct edges of ``edges`` packed for propagation ``src -> dst`` and, if
    ``both``, ``dst -> src``. ``pages`` is ``(page, idx)``."""

    def __init__(self, edges: DataFrame, both: bool = False, block_pages: int | None = None,
                 group_edges: int | None = None):
        spark = edges.sparkSession
        self.width, self.group = block_pages or BLOCK_PAGES, group_edges or GROUP_EDGES
        self._held: list[DataFrame] = []
        # numbers and edges are written once: rounds don't carry the plan of their making
        cut = LineageCutter(spark)
        links = self._hold(edges.select("src", "dst").dropna().dropDuplicates(["src", "dst"]))
        names = links.select(F.col("src").alias("page")).union(links.select("dst")).distinct()
        self.pages = cut(with_global_index(names, ["page"], out="idx"), 0, force=True)
        ends = [self.pages.select(F.col("page").alias(c), F.col("idx").alias(i)) for c, i in
                (("src", "s"), ("dst", "d"))]
        numbered = cut(links.join(ends[0], "src").join(ends[1], "dst").select("s", "d"), 0, force=True)
        self.n, self.edges = self.pages.count(), numbered.count()
        self.blocks = -(-self.n // self.width)
        # no more tasks a round than groups: each costs a start, however little it does
        self.parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                self.blocks + self.edges // self.group))
        self.forward = self._pack(numbered)
        self.backward = self._pack(numbered.select(F.col("d").alias("s"), F.col("s").alias("d"))) if both else None

    def _hold(self, df: DataFrame) -> DataFrame:
        self._held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def _pack(self, numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``(cells, base)``: ``cells (sb, salt, db, e)`` and one row a block with its
        number of pages, its groups and 1 / out-degree of each page."""
        w = self.width
        at = numbered.withColumns({"sb": F.expr(f"cast(s div {w} as int)"), "db": F.expr(f"cast(d div {w} as int)")})
        sizes = at.groupBy("sb").agg(F.ceil(F.count(F.lit(1)) / F.lit(self.group)).cast("int").alias("groups"))
        sizes = self._hold(sizes)   # a row a block: number of pages / BLOCK_PAGES
        salted = at.join(F.broadcast(sizes), "sb").withColumn(
            "salt", F.pmod(F.xxhash64("d"), F.col("groups")).cast("int"))
        code = F.shiftleft(F.pmod("d", F.lit(w)), 32).bitwiseOR(F.pmod("s", F.lit(w)))
        cells = (salted.select("sb", "salt", "db", code.alias("c")).repartition(self.parts, "sb", "salt")
                 .groupBy("sb", "salt", "db").agg(F.sort_array(F.collect_list("c")).alias("e"))
                 .sortWithinPartitions("sb", "salt"))
        degrees = numbered.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
        weights = (degrees.select(F.expr(f"cast(s div {w} as int)").alias("blk"),
                                  F.struct(F.pmod("s", F.lit(w)).cast("int").alias("d"),
                                           (F.lit(1.0) / F.col("n")).alias("y")).alias("p"))
                   .groupBy("blk").agg(F.collect_list("p").alias("p")))    # at most BLOCK_PAGES
        base = (numbered.sparkSession.range(self.blocks).select(F.col("id").cast("int").alias("blk"))
                .join(weights, "blk", "left").join(F.broadcast(sizes.withColumnRenamed("sb", "blk")), "blk", "left")
                .select(F.col("blk").alias("db"), F.lit(-1).alias("sb"),
                        F.coalesce("groups", F.lit(0)).alias("salt"),
                        F.coalesce("p.d", F.array().cast("array<int>")).alias("d"),
                        F.coalesce("p.y", F.array().cast("array<double>")).alias("y")))
        cells, base = self._hold(cells), self._hold(base)
        cells.count()     # a cache is known to be partitioned only once it is filled
        return cells, base

    def start(self, flow, value: float, only_senders: bool = False, weighted: bool = True) -> DataFrame:
        """Scores ``(blk, groups, x, z, top)``: ``value`` on every page (or on those with
        an edge to send), z the share that goes along each edge."""
        return self._settle(flow[1], lambda s, w: np.where(w > 0, value, 0.0) if only_senders
                            else np.full(len(s), value), weighted)

    def step(self, flow, scores: DataFrame, update, nxt=None, weighted: bool = True) -> DataFrame:
        """One round along ``flow``; ``update(sums, weights)`` gives a block's new scores,
        which are to be sent along ``nxt`` (``flow`` by default)."""
        cells, _ = flow
        z = scores.select("blk", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), "z")
        sums = (cells.groupBy("sb", "salt").cogroup(
            z.repartition(self.parts, "blk", "salt").groupBy("blk", "salt")).applyInArrow(_send, _PARTIAL_SQL))
        return self._settle((nxt or flow)[1].unionByName(sums), update, weighted)

    def _settle(self, rows: DataFrame, update, weighted: bool) -> DataFrame:
        n, width = self.n, self.width

        def block(blk, groups, weights, sums):
            x = update(sums, weights)
            z = x * weights if weighted else x
            return pa.record_batch([pa.array([blk], pa.int32()), pa.array([groups], pa.int32()),
                                    pa.array([x], pa.list_(pa.float64())), pa.array([z], pa.list_(pa.float64())),
                                    pa.array([x.max()], pa.float64())], names=["blk", "groups", "x", "z", "top"])

        def add_up(batches):
            held = None
            for batch in batches:
                db, sb, salt, d, y = (batch.column(c) for c in ("db", "sb", "salt", "d", "y"))
                for i in range(batch.num_rows):
                    at, values = d[i].values.to_numpy(), y[i].values.to_numpy()
                    if sb[i].as_py() < 0:      # a block's own row comes before its sums
                        if held:
                            yield block(*held)
                        size = min(width, n - db[i].as_py() * width)
                        held = (db[i].as_py(), salt[i].as_py(), np.zeros(size), np.zeros(size))
                        held[2][at] = values
                    else:
                        held[3][at] += values   # a destination is in a row once
            if held:
                yield block(*held)

        parts = max(1, min(self.parts, self.blocks))
        return (rows.repartition(parts, "db").sortWithinPartitions("db", "sb", "salt")
                .mapInArrow(add_up, "blk int, groups int, x array<double>, z array<double>, top double"))

    def values(self, scores: DataFrame, name: str) -> DataFrame:
        """Long form ``(idx, name)``."""
        return scores.select("blk", F.posexplode("x").alias("o", name)).select(
            (F.col("blk").cast("long") * self.width + F.col("o")).alias("idx"), name)

    def release(self) -> None:
        for df in reversed(self._held):
            df.unpersist()


def _empty(edges: DataFrame, *names: str) -> DataFrame:
    """No rows, in the columns of a result."""
    return edges.select(F.col("src").alias("page"), *[F.lit(0.0).alias(c) for c in names]).limit(0)


def pagerank_power(edges: DataFrame, rounds: int = 40, beta: float = 0.8, checkpoint_every: int = 5,
                   **sizes) -> DataFrame:
    """M9: ``r = (1-beta)/N + beta * M r`` over all N pages; rows ``(page, rank)``."""
    g, cut = PackedGraph(edges, **sizes), LineageCutter(edges.sparkSession, checkpoint_every)
    n = g.n
    if not n:
        return _empty(edges, "rank")
    scores = g.start(g.forward, 1.0 / n)
    for i in range(rounds):
        scores = g.step(g.forward, scores, lambda s, w: (1.0 - beta) / n + beta * s)
        scores = cut(scores, i)
    out = g.pages.join(g.values(scores, "rank"), "idx").select("page", "rank")
    return _finished(g, cut, out)


def pagerank_edge(edges: DataFrame, rounds: int = 10, damping: float = 0.85, checkpoint_every: int = 5,
                  **sizes) -> DataFrame:
    """M8: N pages with out-links start with 1/N; a page that receives something gets
    ``damping * sum + (1 - damping)/N``, another drops out. A score of 0 stands for
    one that dropped out (what a page sends is above 0)."""
    g, cut = PackedGraph(edges, **sizes), LineageCutter(edges.sparkSession, checkpoint_every)
    if not g.n:
        return _empty(edges, "rank")
    n = g.forward[1].agg(F.sum(F.size("d"))).first()[0]
    scores = g.start(g.forward, 1.0 / n, only_senders=True)
    for i in range(rounds):
        scores = g.step(g.forward, scores, lambda s, w: np.where(s > 0, damping * s + (1.0 - damping) / n, 0.0))
        scores = cut(scores, i)
    out = g.pages.join(g.values(scores, "rank").filter("rank > 0"), "idx").select("page", "rank")
    return _finished(g, cut, out)


def hits(edges: DataFrame, rounds: int = 40, checkpoint_every: int = 5, **sizes) -> DataFrame:
    """``a = L^T h; h = L a`` from ``h = 1``; ``(page, hub, authority)``, each divided
    by its maximum (at the cuts, to keep them finite, and at the end)."""
    g, cut = PackedGraph(edges, both=True, **sizes), LineageCutter(edges.sparkSession, checkpoint_every)
    if not g.n:
        return _empty(edges, "hub", "authority")
    hub, top = g.start(g.forward, 1.0, weighted=False), 1.0
    for i in range(rounds):
        scale = 1.0 / top
        auth = g.step(g.forward, hub, lambda s, w, k=scale: s * k, nxt=g.backward, weighted=False)
        last, top = i == rounds - 1, 1.0
        if last:
            auth = cut(auth, i, force=True)
        hub = g.step(g.backward, auth, lambda s, w: s, nxt=g.forward, weighted=False)
        if last or (i + 1) % cut.every == 0:
            hub = cut(hub, i, force=True)
            top = hub.agg(F.max("top")).first()[0] or 1.0
    out = g.pages
    for scores, name in ((hub, "hub"), (auth, "authority")):
        most = scores.agg(F.max("top")).first()[0] or 1.0
        out = out.join(g.values(scores, name).withColumn(name, F.col(name) / most), "idx")
    return _finished(g, cut, out.select("page", "hub", "authority"))


def _finished(g: PackedGraph, cut: LineageCutter, out: DataFrame) -> DataFrame:
    out = cut(out, 0, force=True)
    g.release()
    return out
