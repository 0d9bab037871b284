"""Graph mining over long-form edge lists ``(src, dst)``: friend
recommendation (M6), PageRank in edge-flow (M8) and power-iteration (M9)
form, HITS (M10) and the top/bottom-n report (O3).

Iterative operators cache the distinct edge list (with its out-degree
weight) once.  Each round sends scores along the edges -- broadcasting the
edge list or the score vector when counts taken once show it is small,
otherwise through a salted co-partitioned join (``_Flow``) -- and sums the
contributions per page with partial aggregation: one shuffle of partial
sums per round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.vectors import significant
from lodestar.operators.sequence import with_global_index
from lodestar.plans.guards import bounded_broadcast
from lodestar.plans.iterate import LineageCutter
from lodestar.plans.skew import hot_keys, salt_big, salt_small


#: Significant digits to which scores are compared when ranked.
RANK_DIGITS = 12


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# -- friend recommendation (M6) --------------------------------------------

#: Pairs that a block of users has on average at most; a task counts a block at a time.
BLOCK_PAIRS = 1 << 22

#: Entries of a list that travel in a row; longer lists are several rows.
LIST_PIECE = 2048

_SENT = pa.schema([("blk", pa.int32()), ("direct", pa.bool_()), ("users", pa.binary()), ("list", pa.binary()),
                   ("user_at", pa.binary()), ("list_at", pa.binary())])
_SENT_SQL = "blk int, direct boolean, users binary, list binary, user_at binary, list_at binary"


def _send_lists(batches: Iterator[pa.RecordBatch], blocks: int, placed: bool, nameless: int) -> Iterator[pa.RecordBatch]:
    """Rows (s, d[, at]) in order of s -> each user's list, in pieces, once to every
    block that one of its members is in, beside those members, and once to the
    user's own block as ``direct`` friends."""
    names = ["s", "d", "at"] if placed else ["s", "d"]
    out: list[tuple] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal size
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SENT, strict=True)], schema=_SENT)
        out.clear()
        size = 0

    def close(s: int, d: np.ndarray, at: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        nonlocal size
        place = None if at is None else np.unique(at, return_inverse=True)[1].astype(np.int32)
        blk = d % blocks
        order = np.argsort(blk, kind="stable")
        first = np.flatnonzero(np.diff(blk[order], prepend=-1))
        cuts = [*(4 * first).tolist(), 4 * len(d)]
        users, user_at = d[order].tobytes(), None if place is None else place[order].tobytes()
        to = blk[order[first]].tolist()
        own = np.array([s], np.int32).tobytes()
        known = d[d != nameless]
        for a in range(0, len(known), LIST_PIECE):
            out.append((s % blocks, True, own, known[a:a + LIST_PIECE].tobytes(), None, None))
        for a in range(0, len(d), LIST_PIECE):
            piece, piece_at = d[a:a + LIST_PIECE].tobytes(), None if place is None else place[a:a + LIST_PIECE].tobytes()
            for b, x, y in zip(to, cuts, cuts[1:], strict=False):
                out.append((b, False, users[x:y], piece, None if place is None else user_at[x:y], piece_at))
                size += len(piece) + y - x
                if size > 4 << 20:
                    yield from flush()

    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        cuts = [0, *(np.flatnonzero(np.diff(cols[0])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[-1][0][0] != cols[0][a]:
                yield from close(*_joined(held))
                held = []
            held.append([c[a:b] for c in cols])
    if held:
        yield from close(*_joined(held))
    yield from flush()


def _joined(held: list[list[np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray | None]:
    s, d, *at = (np.concatenate(c) if len(held) > 1 else c[0] for c in zip(*held, strict=True))
    return int(s[0]), d.astype(np.int32), at[0] if at else None


def _int32s(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (in numbers) and numbers of a column of packed arrays."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64) // 4
    return offsets, np.frombuffer(column.buffers()[2] or b"", np.int32)


def _pair_keys(batch: pa.RecordBatch, blocks: int, n: int, larger: bool) -> Iterator[np.ndarray]:
    """Of rows of one block: ``user // blocks * n + member`` of each user beside each
    member of its row's list, at most about 2 * ``BLOCK_PAIRS`` at a time."""
    (uo, users), (lo, members) = _int32s(batch.column("users")), _int32s(batch.column("list"))
    rows = np.repeat(np.arange(len(batch)), np.diff(uo))  # the row of each user
    users = users[uo[0]:uo[-1]]
    placed = batch.column("user_at").null_count < len(batch)
    if placed:
        _, user_at = _int32s(batch.column("user_at"))
        _, list_at = _int32s(batch.column("list_at"))
        at0, lat0 = np.frombuffer(batch.column("user_at").buffers()[1], np.int32)[batch.column("user_at").offset] // 4, lo[0]
        user_at = user_at[at0:at0 + len(users)]
        shift = np.frombuffer(batch.column("list_at").buffers()[1], np.int32)[batch.column("list_at").offset] // 4 - lat0
    size = np.diff(lo)[rows]
    ends = np.cumsum(size)
    a = 0
    while a < len(users):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK_PAIRS, "right")))
        own = size[a:b]
        at = np.arange(own.sum()) + np.repeat(lo[rows[a:b]] - (np.cumsum(own) - own), own)
        user, member = np.repeat(users[a:b].astype(np.int64), own), members[at]
        if placed:
            keep = np.repeat(user_at[a:b], own) < list_at[at + shift]
        else:
            keep = member > user if larger else member != user
        yield (user // blocks * n + member)[keep]
        a = b


class _Counts:
    """Counts by key: a table where all keys of a block are few, else sorted runs."""

    def __init__(self, cells: int):
        self.table = np.zeros(cells, np.int64) if cells <= BLOCK_PAIRS else None
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if self.table is not None:
            self.table += np.bincount(keys, minlength=len(self.table))
            return
        self.held.append(keys)
        self.size += len(keys)
        if self.size > max(BLOCK_PAIRS, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        new = np.sort(np.concatenate([*self.held, self.keys[:0]]))
        self.held, self.size = [], 0
        first = np.flatnonzero(np.diff(new, prepend=-1))
        keys, n = new[first], np.diff(np.append(first, len(new)))
        if len(self.keys):
            both, n = np.concatenate([self.keys, keys]), np.concatenate([self.n, n])
            order = np.argsort(both, kind="stable")
            both = both[order]
            first = np.flatnonzero(np.diff(both, prepend=-1))
            keys, n = both[first], np.add.reduceat(n[order], first)
        self.keys, self.n = keys, n

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        if self.table is not None:
            keys = np.flatnonzero(self.table)
            return keys, self.table[keys]
        self.merge()
        return self.keys, self.n


def _count_block(batches: Iterator[pa.RecordBatch], blocks: int, n: int, top_n: int, larger: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ``_send_lists`` in order of the block -> each user's ``top_n`` best."""
    cells = -(-n // blocks) * n

    def best(blk: int, counts: _Counts, direct: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, shared = counts.done()
        if direct and len(keys):
            friends = np.unique(np.concatenate(direct))
            at = np.minimum(np.searchsorted(friends, keys), len(friends) - 1)
            stranger = friends[at] != keys
            keys, shared = keys[stranger], shared[stranger]
        user = keys // n
        order = np.lexsort((keys, -shared, user))
        first = np.flatnonzero(np.diff(user[order], prepend=-1))
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        order = order[place < top_n]
        yield pa.RecordBatch.from_arrays([pa.array(user[order] * blocks + blk), pa.array(keys[order] % n), pa.array(shared[order])],
                                         names=["u", "c", "n"])

    counts, direct, at = None, [], None
    for batch in batches:
        blks = batch.column("blk").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blks)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if blks[a] != at:
                if counts:
                    yield from best(at, counts, direct)
                at, counts, direct = int(blks[a]), _Counts(cells), []
            part = batch.slice(a, b - a)
            is_direct = part.column("direct")
            for some, listed in ((part.filter(is_direct), True), (part.filter(pc.invert(is_direct)), False)):
                if not len(some):
                    continue
                if listed:
                    (_, users), (lo, members) = _int32s(some.column("users")), _int32s(some.column("list"))
                    uo = _int32s(some.column("users"))[0]
                    direct.append(np.repeat(users[uo[:-1]].astype(np.int64) // blocks * n, np.diff(lo)) + members[lo[0]:lo[-1]])
                else:
                    for keys in _pair_keys(some, blocks, n, larger):
                        counts.add(keys)
    if counts:
        yield from best(at, counts, direct)


def _two_hop_counts(adj: DataFrame, mode: str, top_n: int) -> DataFrame:
    """``(user_id, candidate, n)``: shared neighbours of the ``top_n`` best
    non-friends of each user (all of them are counted, exactly).

    ``symmetric``: both directions; ``list_order``: the reference's
    one-directional emission, friend i -> friend j only for j after i in
    the list (column ``pos`` when present, else id order -- with id-sorted
    lists only larger ids are offered, N3).

    A user of degree d shares d^2 pairs. They are never rows: users get dense numbers
    and are dealt over blocks, of which there are as many as pairs of ``BLOCK_PAIRS``.
    A list goes once to each block that a member of it is in, and a task counts block
    after block. It holds a block's distinct pairs, whatever the degrees.
    """
    placed = mode == "list_order" and "pos" in adj.columns
    parts = _partitions(adj)
    names = adj.select(F.col("src").alias("page")).union(adj.select("dst")).distinct()
    cut = LineageCutter(adj.sparkSession)
    names = cut(with_global_index(names, ["page"], out="idx"), 0, force=True)
    n = names.count()
    nameless = names.filter(F.col("page").isNull()).first()
    rows = adj.filter(F.col("src").isNotNull() & F.col("pos" if placed else "dst").isNotNull())
    sizes = rows.groupBy("src").agg(F.count(F.lit(1)).cast("double").alias("d")).agg(F.sum("d"), F.sum(F.col("d") * F.col("d"))).first()
    edges, pairs = int(sizes[0] or 0), sizes[1] or 0.0
    blocks = max(parts, math.ceil(min(pairs, float(n) * n) / BLOCK_PAIRS))
    s, d = (bounded_broadcast(names.select(F.col("page").alias(c), F.col("idx").alias(i)), known_rows=n)
            for c, i in (("_src", "s"), ("_dst", "d")))
    keys = ["s", "at", "d"] if placed else ["s", "d"]
    numbered = rows.join(s, F.col("src") == F.col("_src")).join(d, F.col("dst").eqNullSafe(F.col("_dst")))
    numbered = numbered.select("s", "d", *([F.col("pos").alias("at")] if placed else []))
    void = nameless["idx"] if nameless else -1
    sent = (numbered.repartition(max(parts, edges >> 21), "s").sortWithinPartitions(*keys)
            .mapInArrow(lambda b: _send_lists(b, blocks, placed, void), _SENT_SQL))
    larger = mode == "list_order"
    tasks = min(blocks, max(parts, math.ceil(pairs / (16 * BLOCK_PAIRS))))
    best = (sent.repartition(tasks, "blk").sortWithinPartitions("blk")
            .mapInArrow(lambda b: _count_block(b, blocks, n, top_n, larger), "u long, c long, n long"))
    user, candidate = (bounded_broadcast(names.select(F.col("page").alias(c), F.col("idx").alias(i)), known_rows=n)
                       for c, i in (("user_id", "u"), ("candidate", "c")))
    return best.join(user, "u").join(candidate, "c").select("user_id", "candidate", "n")


def friend_candidates(adj: DataFrame, top_n: int = 10, mode: str = "symmetric") -> DataFrame:
    """``(user_id, candidate, n, rank)`` for the top ``top_n`` non-friends.

    ``adj`` holds one row per (user, friend) of each user's list.  Counts
    are mutual friends (A7), without direct friends (J4); ranking is count
    desc, id asc (W1).  A user's pairs are counted in one place (see
    ``_two_hop_counts``), which passes on ``top_n`` of them.
    """
    if mode not in ("symmetric", "list_order"):
        raise ValueError("mode must be 'symmetric' or 'list_order'")
    counts = _two_hop_counts(_cached(adj), mode, top_n)
    w = Window.partitionBy("user_id").orderBy(F.desc("n"), F.asc("candidate"))
    return (counts.withColumn("rank", F.row_number().over(w).cast("long"))
            .filter(F.col("rank") <= top_n))


def _cached(df: DataFrame) -> DataFrame:
    """The adjacency is read three or four times (both sides of the
    two-hop join, the anti join, the user list): cache it once."""
    return df if df.storageLevel.useMemory or df.storageLevel.useDisk else df.persist(
        StorageLevel.MEMORY_AND_DISK)


def _users(adj: DataFrame, users: DataFrame | None) -> DataFrame:
    if users is not None:
        return users.select(F.col(users.columns[0]).alias("user_id")).distinct()
    return adj.select(F.col("src").alias("user_id")).distinct()


def recommend_friends(adj: DataFrame, top_n: int = 10, mode: str = "symmetric",
                      users: DataFrame | None = None) -> DataFrame:
    """M6 long form with J12: every user keeps a row (null candidate when
    there is nothing to recommend).  ``users`` lists users whose input row
    may be empty; by default the users with at least one friend.  Users who
    are only listed by others have no row of their own, but get one here
    when there is something to recommend."""
    adj = _cached(adj)
    return _users(adj, users).join(friend_candidates(adj, top_n, mode), "user_id", "full")


def recommend_friends_text(adj: DataFrame, top_n: int = 10, mode: str = "list_order",
                           users: DataFrame | None = None) -> DataFrame:
    """K5 form ``(user_id, recs)``: ids joined by commas in rank order,
    ``''`` for a user without candidates.  The per-user list holds at most
    ``top_n`` entries, so collecting it is bounded."""
    adj = _cached(adj)
    ranked = friend_candidates(adj, top_n, mode)
    lists = ranked.groupBy("user_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "candidate"))),
                                 lambda s: s["candidate"].cast("string")), ",").alias("recs"))
    users = _users(adj, users)
    return (users.join(lists, "user_id", "full")
            .select("user_id", F.coalesce("recs", F.lit("")).alias("recs")))


# -- score propagation shared by PageRank and HITS -------------------------

# Broadcast bounds, checked by counting edges and nodes once per run: an
# edge list this small is broadcast (and the broadcast reused by every round
# planned together); otherwise a score vector this small is broadcast to the
# edge scan each round.
MAX_BROADCAST_EDGES = 1_000_000
MAX_BROADCAST_NODES = 2_000_000


class _Flow:
    """Distinct edges prepared for repeated propagation ``frm -> to``.

    Three physical strategies, chosen from counts taken once:

    * ``edges``: the cached edge list itself is small -- broadcast it; the
      score vector stays where the previous aggregation left it.
    * ``scores``: the node count is below the bound -- broadcast the score
      vector each round. The cached edges are partitioned once by ``(to, salt)``,
      hot ``to`` nodes salted by ``frm``, and summed there, so no edge moves and
      a round shuffles one sum a node and salt, however many edges and tasks.
    * ``salted``: both are large -- hash-partition the edges once on
      ``(frm, salt)``; hot ``frm`` nodes (more than half an average
      partition) are salted by ``to`` into about one partition's worth of
      edges per salt and their score rows repeated per salt, so per round
      only the score vector is shuffled and no task holds a hot node's
      whole edge list.
    """

    def __init__(self, links: DataFrame, frm: str, to: str, n_edges: int, nodes: DataFrame,
                 max_nodes: int | None = None, max_edges: int | None = None):
        self.frm, self.to = frm, to
        max_nodes = MAX_BROADCAST_NODES if max_nodes is None else max_nodes
        max_edges = MAX_BROADCAST_EDGES if max_edges is None else max_edges
        self.mode = ("edges" if n_edges <= max_edges else
                     "scores" if nodes.count() <= max_nodes else "salted")
        self.links = links
        if self.mode != "edges":
            parts = _partitions(links)
            key, other = (frm, to) if self.mode == "salted" else (to, frm)
            self.hot = hot_keys(links, key, parts)
            self.links = (links.withColumn("_salt", salt_big(key, self.hot, other))
                          .repartition(parts, key, "_salt")
                          .persist(StorageLevel.MEMORY_AND_DISK))
            self.links.count()  # a cache is known to be partitioned only once it is filled

    def spread(self, scores: DataFrame, value: str) -> DataFrame:
        """``(page, c)``: ``value * w`` sent along every edge (J9, X3), summed where
        the edges of a page lie together."""
        if self.mode == "edges":
            lk = F.broadcast(self.links)
            j = lk.join(scores, lk[self.frm] == scores.page)
        elif self.mode == "scores":
            j = self.links.join(F.broadcast(scores), self.links[self.frm] == scores.page)
            return (j.groupBy(self.to, "_salt").agg(F.sum(F.col(value) * F.col("w")).alias("c"))
                    .select(F.col(self.to).alias("page"), "c"))
        else:
            sc = scores.withColumn("_s", F.explode(salt_small("page", self.hot)))
            j = self.links.join(sc, (self.links[self.frm] == sc.page)
                                & (self.links["_salt"] == sc["_s"]))
        return j.select(F.col(self.to).alias("page"), (F.col(value) * F.col("w")).alias("c"))

    def release(self) -> None:
        if self.mode != "edges":
            self.links.unpersist()


def _links(edges: DataFrame, weighted: bool) -> DataFrame:
    """Distinct edges (U1); ``w = 1/outdeg(src)`` (A10) or 1; cached."""
    links = edges.select("src", "dst").dropDuplicates(["src", "dst"])
    if weighted:
        deg = links.groupBy("src").agg(F.count(F.lit(1)).alias("_deg"))
        links = links.join(deg, "src").select("src", "dst",
                                              (F.lit(1.0) / F.col("_deg")).alias("w"))
    else:
        links = links.withColumn("w", F.lit(1.0))
    return links.persist(StorageLevel.MEMORY_AND_DISK)


def _nodes(links: DataFrame) -> DataFrame:
    return (links.select(F.col("src").alias("page"))
            .union(links.select(F.col("dst").alias("page"))).distinct()
            .persist(StorageLevel.MEMORY_AND_DISK))


# -- PageRank ---------------------------------------------------------------

def pagerank_edge(edges: DataFrame, rounds: int = 10, damping: float = 0.85,
                  checkpoint_every: int = 5) -> DataFrame:
    """M8: the RDD-job semantics.

    N = pages with out-links; start 1/N on those pages; each round a page's
    rank is ``damping * sum(contrib) + (1 - damping)/N`` over pages that
    received a contribution, so pages without in-links drop out and dead
    ends leak mass.
    """
    spark = edges.sparkSession
    cut = LineageCutter(spark, checkpoint_every)
    links = _links(edges, weighted=True)
    nodes = _nodes(links)
    flow = _Flow(links, "src", "dst", links.count(), nodes)
    pages = flow.links.select(F.col("src").alias("page")).distinct().persist()
    n = pages.count()
    ranks = pages.select("page", F.lit(1.0 / n).alias("rank"))
    for i in range(rounds):
        ranks = (flow.spread(ranks, "rank").groupBy("page")
                 .agg((F.sum("c") * damping + (1.0 - damping) / n).alias("rank")))
        ranks = cut(ranks, i, force=i == rounds - 1)
    flow.release()
    for df in (pages, nodes, links):
        df.unpersist()
    return ranks


def pagerank_power(edges: DataFrame, rounds: int = 40, beta: float = 0.8,
                   checkpoint_every: int = 5) -> DataFrame:
    """M9: ``r = (1-beta)/N + beta * M r`` over all N nodes (src or dst).

    Every node keeps its teleport share; a node without in-links gets a
    zero contribution through the union with the node list, so the round
    is a single aggregation (no outer join).  Dangling nodes contribute
    nothing (N6).
    """
    spark = edges.sparkSession
    cut = LineageCutter(spark, checkpoint_every)
    links = _links(edges, weighted=True)
    nodes = _nodes(links)
    n = nodes.count()
    flow = _Flow(links, "src", "dst", links.count(), nodes)
    zero = nodes.select("page", F.lit(0.0).alias("c"))
    ranks = nodes.select("page", F.lit(1.0 / n).alias("rank"))
    for i in range(rounds):
        ranks = (flow.spread(ranks, "rank").unionByName(zero).groupBy("page")
                 .agg(((1.0 - beta) / n + beta * F.sum("c")).alias("rank")))
        ranks = cut(ranks, i, force=i == rounds - 1)
    flow.release()
    nodes.unpersist()
    links.unpersist()
    return ranks


# -- HITS -------------------------------------------------------------------

def hits(edges: DataFrame, rounds: int = 40, checkpoint_every: int = 5) -> DataFrame:
    """``a = L^T h; h = L a`` from ``h = 1``; output ``(page, hub,
    authority)`` each divided by its maximum.

    Dividing by the max every round only rescales the vectors, so the
    rescaling is applied at each lineage cut (to keep values finite) and
    at the end, not as one driver action per half-round.  A node absent
    from a score vector has score 0 and contributes nothing to the next
    half-round, so intermediate vectors hold only nodes that received a
    contribution; the node list is joined in once, at the end.
    """
    spark = edges.sparkSession
    cut = LineageCutter(spark, checkpoint_every)
    links = _links(edges, weighted=False)
    nodes = _nodes(links)
    e = links.count()
    forward, backward = _Flow(links, "src", "dst", e, nodes), _Flow(links, "dst", "src", e, nodes)

    def step(flow: _Flow, scores: DataFrame) -> DataFrame:
        return flow.spread(scores, "s").groupBy("page").agg(F.sum("c").alias("s"))

    def by_max(scores: DataFrame) -> DataFrame:
        top = scores.agg(F.max("s")).first()[0] or 0.0
        return scores.select("page", (F.col("s") / top).alias("s")) if top > 0 else scores

    hub = nodes.select("page", F.lit(1.0).alias("s"))
    auth = nodes.select("page", F.lit(1.0).alias("s"))
    for i in range(rounds):
        auth = step(forward, hub)
        hub = step(backward, auth)
        if i < rounds - 1 and (i + 1) % cut.every == 0:
            hub = by_max(cut(hub, i, force=True))
    auth = by_max(cut(auth, rounds, force=True))
    hub = by_max(cut(hub, rounds, force=True))
    out = (nodes.join(hub.select("page", F.col("s").alias("hub")), "page", "left")
           .join(auth.select("page", F.col("s").alias("authority")), "page", "left")
           .select("page", F.coalesce("hub", F.lit(0.0)).alias("hub"),
                   F.coalesce("authority", F.lit(0.0)).alias("authority")))
    out = cut(out, rounds, force=True)
    forward.release()
    backward.release()
    nodes.unpersist()
    links.unpersist()
    return out


# -- top / bottom report (O3) ----------------------------------------------

def rank_extremes(scores: DataFrame, score: str = "rank", key: str = "page",
                  n: int = 5) -> DataFrame:
    """``(side, pos, key)``: the n lowest and n highest by ``score``, both
    listed low to high (N17).  Scores equal to ``RANK_DIGITS`` significant
    digits tie (their sums differ in the last bits from run to run); ties
    follow a stable ascending sort by id, so the top list prefers the larger
    id.  Each side is a distributed top-k (``TakeOrderedAndProject``); only 2n
    rows are ever ranked."""
    scores = scores.withColumn(score, significant(score, RANK_DIGITS))
    bottom = scores.orderBy(F.asc(score), F.asc(key)).limit(n)
    top = scores.orderBy(F.desc(score), F.desc(key)).limit(n)
    wb = Window.orderBy(F.asc(score), F.asc(key))
    wt = Window.orderBy(F.desc(score), F.desc(key))
    return (bottom.select(F.lit("bottom").alias("side"),
                          F.row_number().over(wb).cast("long").alias("pos"), key)
            .unionByName(top.select(F.lit("top").alias("side"),
                                    (F.lit(n + 1) - F.row_number().over(wt)).cast("long")
                                    .alias("pos"), key)))
