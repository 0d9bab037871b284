"""SimHash near-dedup (operator 4): vantage-point trees over fingerprints.

Fingerprints: words (A-Z lower-cased), ``shingle``-word shingles with repeats,
XXH64 with seed 42 of each; a bit is set if it is set in over half of the
hashes. Too few words make one shingle, none the fingerprint zero.

Links: copies collapse first, so the search is over distinct fingerprints. A
vantage-point tree is fitted on a bounded sample (about ``SAMPLE`` fingerprints,
those of the smallest hash): a node holds a fingerprint v and a radius r, near points
(distance up to r) go left, the others right. Every fingerprint resides in one
leaf. A pair within ``max_bits`` that a node parts lies close to its radius,
by the triangle inequality: so residents of the left in the last ``max_bits``
before the radius also visit the right, and a visitor goes on to each side that
its distance doesn't rule out. Leaves are shards, dealt to tasks by the load the
sample shows; inside a task the same splitting goes on until a block is small,
and visitors and residents are compared there exactly. A split that boundary
copies would make useless is not made; such a leaf (many fingerprints within a
few bits) is dealt out in blocks of residents that each meet the whole leaf.
A shard returns a spanning forest of the links it found, which loses no
component, and the forests are merged by star contraction.

Every pair within ``max_bits`` is found whatever the sample was: it only sets
the balance. Null and empty texts share fingerprint zero and link as others
do. Long texts are hashed in pieces of words, whole. Ids may repeat or be null; a
null id is never a component's id unless all ids of the component are null.
Empty tables give no rows. ``near_duplicates`` reads id and text alone;
``kept_rows`` carries the row in a struct: other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, frugal, shuffle_partitions, written
from lodestar.llm.components import components

SEED = 42
#: Fingerprints that the tree is fitted on (0.5 MB on the driver).
SAMPLE = 65_536
#: Resident-visitor comparisons that a block makes without a further split.
BLOCK_PAIRS = 1 << 21
PART_BYTES = 8 << 20
PIECE = 1 << 20
SPACE = re.compile(rb"[ \t-\r]")


def pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in turn, those of about ``PIECE`` bytes at a time."""
    at = 0
    while at < len(data):
        gap = SPACE.search(data, at + PIECE)
        stop = gap.start() if gap else len(data)
        yield data[at:stop].split()  # bytes: ASCII rules only
        at = stop


def fingerprint(text: str | None, shingle: int) -> int:
    digest, counts, n = xxhash.xxh64_digest, np.zeros(64, np.int64), 0
    found: list[bytes] = []
    for words in pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        found += words
        if len(found) >= shingle:
            joined = b" ".join(found)
            ends = [e - 1 for e in accumulate(len(w) + 1 for w in found)]
            starts = [0] + [e + 1 for e in ends]
            hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:], strict=False)])
            bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
            counts += bits.sum(0, dtype=np.int64)
            n += len(bits)
            found = found[len(found) - shingle + 1:]  # shingles that reach into the next piece
    if not n and found:
        counts += np.unpackbits(np.frombuffer(digest(b" ".join(found), SEED), np.uint8))
        n = 1
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text",
                 carry: Sequence[str] = ()) -> DataFrame:
    """Per row: key, ``carry``, fp (the 64 bits as a long)."""
    rows = docs.select(F.col(key).alias("key"), *carry, F.col(text).alias("text"))
    names = ["key", *carry]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", PART_BYTES):
                fp = [fingerprint(t, shingle) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(fp, pa.int64())], names=[*names, "fp"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(frugal(hashed), f"{kinds}, fp long").withColumnRenamed("key", key)


def distances(fps: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(fps ^ v)


def vantage(residents: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[np.uint64, int] | None:
    """The split whose fuller side is smallest, from a few candidate points and
    radii; None if no split takes a fifth off."""
    best, least = None, 0.8 * (len(residents) + len(visitors))
    for v in residents[:: max(1, len(residents) // 5)][:6]:
        near = np.bincount(distances(residents, v), minlength=65).cumsum()
        seen = np.bincount(distances(visitors, v), minlength=65).cumsum()
        at = np.arange(65)
        low, high = np.maximum(at - max_bits, -1), np.minimum(at + max_bits, 64)
        below = lambda c: np.where(low >= 0, c[np.maximum(low, 0)], 0)
        left = near + seen[high]
        right = near[64] - below(near) + seen[64] - below(seen)
        r = int(np.maximum(left, right).argmin())
        if 0 < near[r] < near[64] and max(left[r], right[r]) < least:
            best, least = (v, r), max(left[r], right[r])
    return best


def sides(residents: np.ndarray, visitors: np.ndarray, v: np.uint64, r: int, max_bits: int) -> tuple:
    """Index arrays: residents and visitors of the left, then of the right."""
    d, e = distances(residents, v).astype(np.int16), distances(visitors, v).astype(np.int16)
    left = d <= r
    return (np.flatnonzero(left), np.flatnonzero(e <= r + max_bits),
            np.flatnonzero(~left), np.flatnonzero(e > r - max_bits), np.flatnonzero(left & (d > r - max_bits)))


@dataclass
class Node:
    v: np.uint64 = np.uint64(0)
    r: int = -1
    left: int = -1
    right: int = -1
    first_shard: int = -1  # of a leaf
    blocks: int = 1


def fit_tree(sample: np.ndarray, shards: int, max_bits: int) -> tuple[list[Node], list[float]]:
    """Tree with about ``shards`` leaves' worth of shards; load of each shard."""
    nodes, loads = [], []
    target = max(8, len(sample) / max(1, shards))

    def grow(res: np.ndarray, vis: np.ndarray) -> int:
        me = len(nodes)
        nodes.append(Node())
        split = vantage(res, vis, max_bits) if len(res) > target else None
        if split is None:
            blocks = max(1, round(len(res) / target))
            nodes[me].first_shard, nodes[me].blocks = len(loads), blocks
            loads.extend([(len(res) + len(vis)) * (1 + len(res) / blocks / target)] * blocks)
            return me
        v, r = split
        a, b, c, d, more = sides(res, vis, v, r, max_bits)
        nodes[me].v, nodes[me].r = v, r
        nodes[me].left = grow(res[a], vis[b])
        nodes[me].right = grow(res[c], np.concatenate([vis[d], res[more]]))
        return me

    grow(sample, sample[:0])
    return nodes, loads


def deal(loads: list[float], tasks: int) -> np.ndarray:
    """Task of each shard: the heaviest first, each to the least loaded task."""
    import heapq

    heap = [(0.0, t) for t in range(tasks)]
    out = np.zeros(len(loads), np.int32)
    for shard in sorted(range(len(loads)), key=lambda s: -loads[s]):
        load, t = heapq.heappop(heap)
        out[shard] = t
        heapq.heappush(heap, (load + loads[shard], t))
    return out


def routed(nodes: list[Node], fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fps, shard, resident?) of every stay and visit."""
    out: list[tuple] = []

    def walk(me: int, res: np.ndarray, vis: np.ndarray) -> None:
        node = nodes[me]
        if not len(res) and not len(vis):
            return
        if node.first_shard < 0:
            a, b, c, d, more = sides(fps[res], fps[vis], node.v, node.r, max_bits)
            walk(node.left, res[a], vis[b])
            walk(node.right, res[c], np.concatenate([vis[d], res[more]]))
            return
        own = (fps[res] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % node.blocks
        for block in range(node.blocks):
            for who, stays in ((res[own == block], True), (np.concatenate([res[own != block], vis]), False)):
                out.append((who, np.full(len(who), node.first_shard + block, np.int32), np.full(len(who), stays)))

    walk(0, np.arange(len(fps)), np.zeros(0, np.int64))
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, k) for i, k in enumerate((np.int64, np.int32, bool)))


def near_pairs(res: np.ndarray, vis: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (resident, resident or len(res) + visitor) within max_bits."""
    todo = [(np.arange(len(res)), np.arange(len(vis)))]
    while todo:
        r, v = todo.pop()
        if not len(r):
            continue
        split = vantage(res[r], vis[v], max_bits) if len(r) * (len(r) + len(v)) > BLOCK_PAIRS else None
        if split:
            a, b, c, d, more = sides(res[r], vis[v], *split, max_bits)
            todo.append((r[a], v[b]))
            # a left resident that visits the right is a visitor there
            yield from _visiting(res, vis, r[c], v[d], r[more], max_bits)
            todo.append((r[c], v[d]))
            continue
        everyone = np.concatenate([res[r], vis[v]])
        names = np.concatenate([r, v + len(res)])
        step = max(1, BLOCK_PAIRS // len(everyone))
        for at in range(0, len(r), step):
            x, y = np.nonzero(np.bitwise_count(res[r[at:at + step], None] ^ everyone[None, :]) <= max_bits)
            keep = names[y] != r[at + x]
            yield r[at + x[keep]], names[y[keep]]


def _visiting(res: np.ndarray, vis: np.ndarray, r: np.ndarray, v: np.ndarray, guests: np.ndarray,
              max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of residents r with the guests (residents of another side)."""
    todo = [(r, guests)]
    while todo:
        a, g = todo.pop()
        if not len(a) or not len(g):
            continue
        split = vantage(res[a], res[g], max_bits) if len(a) * len(g) > BLOCK_PAIRS else None
        if split:
            d, e = distances(res[a], split[0]).astype(np.int16), distances(res[g], split[0]).astype(np.int16)
            todo.append((a[d <= split[1]], g[e <= split[1] + max_bits]))
            todo.append((a[d > split[1]], g[e > split[1] - max_bits]))
            continue
        step = max(1, BLOCK_PAIRS // len(g))
        for at in range(0, len(a), step):
            x, y = np.nonzero(np.bitwise_count(res[a[at:at + step], None] ^ res[g][None, :]) <= max_bits)
            yield a[at + x], g[y]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least index of each index's component."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = root[a], root[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    return root


def links(points: DataFrame, max_bits: int = 2, sample: int = SAMPLE) -> DataFrame:
    """``points``: distinct ``fp``. Edges (a, b) that span the components of
    "at most max_bits bits differ"."""
    spark = points.sparkSession
    tasks = shuffle_partitions(spark)
    share = int(min(1.0, sample / max(1, points.count())) * (1 << 40))
    place = F.shiftrightunsigned(F.xxhash64("fp"), 24)  # distinct fingerprints, so about ``sample`` of them
    drawn = [r.fp for r in points.select("fp").filter(place < share).collect()]
    nodes, loads = fit_tree(np.sort(np.array(drawn, np.int64).view(np.uint64)), 2 * tasks, max_bits)
    task_of = deal(loads, tasks)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            who, shard, stays = routed(nodes, fps, max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(task_of[shard]), pa.array(shard), pa.array(fps.view(np.int64)[who]), pa.array(stays)],
                names=["task", "shard", "fp", "stays"])

    def shard_links(fps: np.ndarray, stays: np.ndarray) -> pa.RecordBatch | None:
        res, vis = fps[stays], fps[~stays]
        everyone = np.concatenate([res, vis])
        root = forest(len(everyone), near_pairs(res, vis, max_bits))
        moved = np.flatnonzero(root != np.arange(len(root)))
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays([pa.array(everyone[moved].view(np.int64)), pa.array(everyone[root[moved]].view(np.int64))],
                                          names=["a", "b"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        at = None
        for batch in batches:  # in order of the shard
            shard = batch.column("shard").to_numpy()
            fps, stays = batch.column("fp").to_numpy().view(np.uint64), batch.column("stays").to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if shard[a] != at and held:
                    if out := shard_links(*map(np.concatenate, zip(*held, strict=True))):
                        yield out
                    held = []
                at = shard[a]
                held.append((fps[a:b], stays[a:b]))
        if held and (out := shard_links(*map(np.concatenate, zip(*held, strict=True)))):
            yield out

    dealt = (points.select("fp").mapInArrow(frugal(route), "task int, shard int, fp long, stays boolean")
             .repartitionById(tasks, "task").sortWithinPartitions("shard", "stays", "fp"))
    return dealt.mapInArrow(frugal(search), "a long, b long")


def classes(rows: DataFrame, max_bits: int, key: str) -> DataFrame:
    """``rows`` (written; key, fp) -> fp, root (a fingerprint that names the
    component), component_id."""
    points = written(rows.groupBy("fp").agg(F.min(key).alias("least")), "points")
    joined = components(written(links(points, max_bits), "links"), "a", "b")
    roots = written(points.join(joined, F.col("fp") == F.col("vertex"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    return roots.join(roots.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id (the smallest id
    that links of up to ``max_bits`` bits reach, its own included)."""
    rows = written(fingerprints(docs, shingle, key, text), "fingerprints")
    return rows.join(classes(rows, max_bits, key), "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def kept_rows(docs: DataFrame, shingle: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with the columns of ``docs``: of its smallest
    id, or of some null id if it has no other; if that id has several texts
    there, that of the smallest hash."""
    tagged = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.struct("*").alias("_row")).withColumns(
        {"_a": F.xxhash64("_key", "_text"), "_b": F.xxhash64(F.lit(1), "_text", "_key")})
    rows = written(fingerprints(tagged, shingle, "_key", "_text", ["_a", "_b"]), "fingerprints")
    found = rows.join(classes(rows, max_bits, "_key"), "fp").groupBy("root", "_key", "_a", "_b").agg(F.count("*").alias("_n"))
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), "_a", "_b", "_n")).alias("first")
    best = written(found.groupBy("root").agg(first).select("first._a", "first._b", "first._n"), "kept")
    kept = tagged.join(best.select("_a", "_b"), ["_a", "_b"], "left_semi")
    if not best.filter("_n > 1").isEmpty():  # whole rows that repeat
        kept = kept.dropDuplicates(["_a", "_b"])
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
