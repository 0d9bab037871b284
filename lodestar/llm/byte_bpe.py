"""Byte-level BPE encoding and decoding (operator 8).

Encoding. A text of up to ``chunk`` characters is pre-tokenised in one go. A
longer one becomes chunks that overlap by ``overlap`` characters; they are
dealt over all tasks and pre-tokenised there in parallel, each from its own
start. A chunk may start inside a pre-token, so its first boundaries can be
wrong; but a pre-token depends on nothing to its left, so from the first
boundary that it shares with the chunk before, both agree for good. The
chunks are stitched there, and each one encodes its pieces from its own
stitch to the next one's. A text in which two chunks share no boundary (a run
longer than the overlap) is pre-tokenised whole instead.

Pieces: the distinct ones of a part are merged in lockstep, all at once, the
pair of lowest rank first and the leftmost among equals; long pieces use a
heap. Ids are packed as little-endian unsigned 32-bit integers.

Decoding concatenates the raw bytes of the ids.

Null and empty texts have no ids and decode to no bytes. Repeated rows give
repeated results; an empty table gives none. Only the named columns are read.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, frugal

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 12
PART_BYTES = 1 << 20
#: Pieces remembered between parts of a task, and lockstep's longest piece.
MEMORY = 100_000
LOCKSTEP = 32
NO_RANK = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(1)
def token_bytes(path: str) -> pa.Array:
    """Token bytes by id (= rank)."""
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return pa.array(tokens, pa.large_binary())


class Vocabulary:
    """Rank of every token and of every pair that merges."""

    def __init__(self, path: str):
        self.ranks = ranks = read_ranks(path)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each merged pair; NO_RANK where it doesn't merge or b < 0."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (b >= 0), self.values[at], NO_RANK)

    def pair_rank(self, a: int, b: int) -> int | None:
        key = a << 32 | b
        at = int(np.searchsorted(self.keys, key))
        return int(self.values[at]) if at < len(self.keys) and self.keys[at] == key else None

    def merge_long(self, piece: bytes) -> np.ndarray:
        """One long piece by a heap of (rank, position)."""
        n = len(piece)
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        start = np.array(ids)
        first = self.pair_ranks(start[:-1], start[1:]).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = nxt[i]
            if j < n and (r := self.pair_rank(ids[i], ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue  # one of the two was merged meanwhile
            ids[i], alive[j], nxt[i] = r, False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], np.int32)

    def merge_lockstep(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Pieces of 2..width bytes, merged together; packed ids per piece."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.full((len(pieces), width + 1), -1, np.int32)
        inside = np.arange(width + 1) < lengths[:, None]
        ids[inside] = self.byte_ids[flat]
        done: list[bytes] = [b""] * len(pieces)
        who = np.arange(len(pieces))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        cols = np.arange(width + 1)
        while len(who):
            at = ranks.argmin(1)
            row = np.arange(len(who))
            best = ranks[row, at]
            over = best == NO_RANK
            if over.any():
                for i in np.flatnonzero(over):
                    line = ids[i]
                    done[who[i]] = line[line >= 0].astype("<u4").tobytes()
                live = ~over
                who, ids, ranks, at, best = who[live], ids[live], ranks[live], at[live], best[live]
                row = np.arange(len(who))
                if not len(who):
                    break
            ids[row, at] = best
            shift = np.minimum(cols + (cols > at[:, None]), width)
            ids = np.take_along_axis(ids, shift, 1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, shift[:, :-1].clip(max=width - 1), 1)
            ranks[:, -1] = NO_RANK
            ranks[row, at] = self.pair_ranks(best, ids[row, at + 1])
            left = at > 0
            ranks[row[left], at[left] - 1] = self.pair_ranks(ids[row[left], at[left] - 1], best[left])
        return done

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LOCKSTEP:
                out[i] = self.merge_long(piece).astype("<u4").tobytes()
            elif piece:
                by_width.setdefault((len(piece) + 3) // 4 * 4, []).append(i)
        for width, which in by_width.items():
            for at in range(0, len(which), 1 << 15):
                some = which[at:at + (1 << 15)]
                for i, ids in zip(some, self.merge_lockstep([pieces[i] for i in some], width), strict=True):
                    out[i] = ids
        return out


@functools.lru_cache(1)
def vocabulary_of(path: str) -> Vocabulary:
    """One a Python worker, for the tasks that it runs."""
    return Vocabulary(path)


class Encoder:
    """Encodes lists of pieces, remembering those met before."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary_of(path)
        self.memory: dict[str, bytes] = {}

    def packed(self, pieces: list[str], ends: list[int]) -> pa.Array:
        """Ids of consecutive texts; ``ends``: pieces up to each text's end."""
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = [self.memory.get(p) for p in distinct]
        new = [i for i, f in enumerate(found) if f is None]
        for i, ids in zip(new, self.vocabulary.encode_pieces([distinct[i].encode() for i in new]), strict=True):
            found[i] = ids
        if len(self.memory) + len(new) > MEMORY:
            self.memory.clear()
        self.memory.update((distinct[i], found[i]) for i in new[:MEMORY] if len(distinct[i]) <= 64)
        all_ids = pa.array(found, pa.large_binary()).take(coded.indices)
        n, (_, offsets, data) = len(all_ids), all_ids.buffers()
        offsets = np.frombuffer(offsets, np.int64, n + 1, 8 * all_ids.offset)
        at = offsets[np.concatenate([[0], ends]).astype(np.int64)] if n else np.zeros(len(ends) + 1, np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), data or pa.py_buffer(b"")]
                                                ).cast(pa.binary())


def boundaries(pattern: regex.Pattern, text: str, start: int) -> list[int]:
    """Where pre-tokens start, as positions in the whole text."""
    return [start + m.start() for m in pattern.finditer(text)]


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, part_bytes: int = PART_BYTES) -> DataFrame:
    """key, ids (binary: little-endian unsigned 32-bit integers). ``ranks`` is
    a path that every executor has; ``pattern`` matches all of any text."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be positive and not exceed a chunk")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, find = Encoder(ranks), regex.compile(pattern).findall
        for batch in batches:
            for part in byte_slices(batch, "text", part_bytes):
                pieces: list[str] = []
                ends = []
                for t in part.column("text").to_pylist():
                    pieces += find(t)
                    ends.append(len(pieces))
                yield pa.RecordBatch.from_arrays([part.column("key"), encoder.packed(pieces, ends)], names=["key", "ids"])

    def pre_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            for part in byte_slices(batch, "text", part_bytes):
                starts = [boundaries(compiled, t, i * chunk) for i, t in
                          zip(part.column("i").to_pylist(), part.column("text").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(starts, pa.list_(pa.int32()))],
                                                 names=[*part.schema.names, "starts"])

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks)
        for batch in batches:
            for part in byte_slices(batch, "text", part_bytes):
                pieces: list[str] = []
                ends = []
                for r in part.select(["i", "text", "starts", "begin", "stop"]).to_pylist():
                    low = r["i"] * chunk
                    high = low + len(r["text"]) if r["stop"] is None else r["stop"]
                    at = [s for s in r["starts"] if r["begin"] <= s < high] + [high]
                    pieces += [r["text"][a - low:b - low] for a, b in zip(at, at[1:], strict=False)]
                    ends.append(len(pieces))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("i"), encoder.packed(pieces, ends)], names=["row", "i", "ids"])

    short = rows.filter(F.length("text") <= chunk).mapInArrow(frugal(whole), f"key {kind}, ids binary")
    long = rows.filter(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    chunks = (long.withColumn("i", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int"))))
              .withColumn("text", F.substring("text", F.col("i") * chunk + 1, F.lit(chunk + overlap))))
    dealt = chunks.repartition("row", "i").mapInArrow(
        pre_tokens, f"key {kind}, text string, row long, i int, starts array<int>")
    # a stitch: the first boundary that the chunk before and this chunk share
    order = Window.partitionBy("row").orderBy("i")
    own_start = F.col("i") * chunk
    tail = F.filter("starts", lambda s: s >= own_start + chunk)
    met = F.array_min(F.array_intersect(F.lag("tail").over(order), F.filter("starts", lambda s: s < own_start + overlap)))
    stitched = (dealt.withColumn("tail", tail).withColumn("begin", F.when(F.col("i") == 0, 0).otherwise(met))
                .withColumns({"stop": F.lead("begin").over(order),
                              "broken": F.max((F.col("begin").isNull()).cast("int")).over(Window.partitionBy("row"))})
                .drop("tail"))
    good = stitched.filter("broken = 0")
    joined = (good.select("row", "i", "text", "starts", "begin", "stop").mapInArrow(frugal(pieces_of), "row long, i int, ids binary")
              .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", "ids"))).alias("parts"))
              .select("row", F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
              .join(good.filter("i = 0").select("row", "key"), "row").select("key", "ids"))
    rest = (stitched.filter("broken = 1").groupBy("row", "key")
            .agg(F.array_sort(F.collect_list(F.struct("i", F.substring("text", 1, chunk).alias("text")))).alias("parts"))
            .select("key", F.array_join("parts.text", "").alias("text"))
            .mapInArrow(frugal(whole), f"key {kind}, ids binary"))
    return short.unionAll(joined).unionAll(rest).withColumnRenamed("key", key)


def decode(coded: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded",
           part_bytes: int = PART_BYTES, keep_ids: bool = False) -> DataFrame:
    """``coded`` with the raw bytes (column ``out``) in place of, or beside,
    the ids."""
    rest = [c for c in coded.columns if c != out and (keep_ids or c != ids)]
    kinds = ", ".join(f"`{c}` {coded.schema[c].dataType.simpleString()}" for c in rest)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(ranks)
        for batch in batches:
            for part in byte_slices(batch, ids, part_bytes):
                packed = part.column(ids).fill_null(b"").cast(pa.large_binary())
                packed = pa.concat_arrays([packed])
                at = np.frombuffer(packed.buffers()[1], np.int64, len(packed) + 1, 8 * packed.offset)
                body = packed.buffers()[2]
                flat = np.frombuffer(body, "<u4", int(at[-1] - at[0]) // 4, int(at[0])) if body is not None else np.zeros(0, "<u4")
                raws = tokens.take(pa.array(flat))
                n, (_, offsets, data) = len(raws), raws.buffers()
                offsets = np.frombuffer(offsets, np.int64, n + 1, 8 * raws.offset) if n else np.zeros(1, np.int64)
                cuts = offsets[(at - at[0]) // 4]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in rest],
                     pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(cuts), data or pa.py_buffer(b"")]
                                                      ).cast(pa.binary())], names=[*rest, out])

    return coded.mapInArrow(frugal(raw), f"{kinds}, `{out}` binary" if rest else f"`{out}` binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text",
               keep_ids: bool = False, **how) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 (and the ids) of every row."""
    coded = encode(docs, ranks, pattern, key, text, **how).withColumns(
        {"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_sha256": F.sha2("ids", 256)})
    return decode(coded, ranks, keep_ids=keep_ids).select(
        key, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), *["ids"] * keep_ids)
