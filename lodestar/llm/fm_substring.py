"""Substring dedup (operator 5): matching statistics on FM-index shards.

A window is ``window`` consecutive words of a document; words under a window
whose word sequence also starts in a document of a smaller id are removed.

Routing. The corpus is cut into shards by content, so that a document meets
only the shards that can hold its windows. A window's anchor is the smallest
hash among its ``gram``-word grams: equal windows have equal anchors. Anchors
are counted over all documents (partial sums first); only windows whose anchor
occurs in two documents or more go on, as segments: runs of windows that share
an anchor's position. A segment goes to its anchor's shard. An anchor in more
than ``HOT_DOCS`` documents would fill a shard with its contexts, so its
windows are routed one by one, by the hash of all their words.

Shard. Routes are hashed into buckets, one per shuffle partition, and a bucket
that is large into shards. The distinct segments of a shard become a compressed
FM-index: the Burrows-Wheeler transform of their word numbers, sorted to the
depth of a window, in a wavelet tree of packed bits with block counts. All
segments are streamed against it by backward search. The matching statistic of
a position is the length, up to a window, of the longest word sequence that
ends there and occurs elsewhere in the shard too. Where it reaches a window,
the suffix interval gives all occurrences, and their least id is reported.

Groups. Documents are hashed into groups whose size doesn't grow with the
corpus; all letters between groups and shards hold one row per group at most
for one text, so copies and hot passages cost a row a group. The answers come
back to the groups as intervals of windows, named by two 64-bit hashes of the
segment's words, and the documents there are cut.

Null and empty texts have no words. A null id is larger than all others.
Rows that repeat an id are one document: they don't remove each other's words.
Empty tables give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, is_space, mix64, powers, shuffle_partitions, text_buffers, word_hashes, word_spans

WINDOW = 13
GRAM = 5
HOT_DOCS = 4096
#: Groups of documents, and buckets of routes, per shuffle partition: a group
#: sends one letter a bucket, so their product sets the number of letters.
GROUPS = 4
BUCKETS = 1
#: Bytes of segments, copies counted, for which a bucket builds one index.
SHARD_BYTES = 8 << 20
PART_BYTES = 4 << 20
LAST = np.int64(2**63 - 1)  # stands for a null id
BASES = (0xD6E8FEB86659FD93, 0xA5CB9243F1ED4F35)


@dataclass
class Windows:
    """Words, windows and anchors of consecutive texts."""

    data: np.ndarray
    s: np.ndarray
    e: np.ndarray
    first: np.ndarray  # index of each text's first word, then the end
    hashes: np.ndarray  # of words
    start: np.ndarray  # first word of each window
    doc: np.ndarray  # text of each window
    anchor: np.ndarray  # hash
    run: np.ndarray  # first window of each run; a run shares doc and anchor position
    run_of: np.ndarray
    offset: np.ndarray  # of a window in its run


def windows_of(texts: pa.Array, window: int, gram: int) -> Windows:
    offsets, data = text_buffers(texts)
    s, e, first = word_spans(offsets, data)
    hashes = word_hashes(data, s, e)
    n = len(s)
    none = np.zeros(0, np.int64)
    if n < window:
        return Windows(data, s, e, first, hashes, none, none, none.astype(np.uint64), none, none, none)
    grams = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        grams = grams * np.uint64(BASES[0]) + hashes[j:n - gram + 1 + j]
    grams = mix64(grams)
    span = window - gram + 1
    least = grams[:n - window + 1].copy()
    for j in range(1, span):
        np.minimum(least, grams[j:n - window + 1 + j], out=least)
    at = np.zeros(n - window + 1, np.int64)
    for j in range(span - 1, -1, -1):
        at[grams[j:n - window + 1 + j] == least] = j
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    position = start + at[start]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(position) != 0) | (np.diff(doc[start]) != 0)
    run = np.flatnonzero(new)
    run_of = np.cumsum(new) - 1
    return Windows(data, s, e, first, hashes, start, doc[start], least[start], run, run_of, np.arange(len(start)) - run[run_of])


def sequence_names(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each word sequence [begin, end)."""
    out = []
    for base in BASES:
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix64(hashes + np.uint64(base)) * powers(base, len(hashes)), out=sums[1:])
        h = (sums[end] - sums[begin]) * powers(pow(base, -1, 1 << 64), len(hashes) + 1)[begin]
        out.append(mix64(h + (end - begin).astype(np.uint64)))
    return out[0], out[1]


def spaced(w: Windows) -> tuple[bytes, np.ndarray]:
    """All words, each followed by one space, and where each one starts."""
    size = w.e - w.s
    at = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(at[-1], 32, np.uint8)
    inside = np.flatnonzero(~is_space(w.data))
    out[inside + np.repeat(at[:-1] - w.s, size)] = w.data[inside]
    return out.tobytes(), at


def keys_of(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(LAST)).to_numpy(zero_copy_only=False)


# --- compressed index ------------------------------------------------------


class Bits:
    """A packed bit vector with the count of ones before each 64-bit block."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.blocks = np.packbits(padded.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64).ravel()
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


class WaveletTree:
    """Rank over a sequence of numbers; one bit vector a level, the zeros of a
    level before its ones in the next."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for level in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (sequence >> level & 1).astype(bool)
            self.levels.append((level, Bits(bit), int(len(bit) - bit.sum())))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        every = np.arange(symbols)
        self.origin = self._walk(every, np.zeros(symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._walk(symbol, at) - self.origin[symbol]


class FMIndex:
    """Over ``text`` (0 separates segments), for patterns of up to 16 words."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        rank = text.astype(np.int64)
        for step in (1, 2, 4, 8):  # ranks by 2, 4, 8, 16 words
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:]
            pair = rank * (int(rank.max()) + 1) + after
            order = np.argsort(pair)
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.diff(pair[order], prepend=pair[order[0]]) != 0)
        self.suffixes = order
        symbols = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.tree = WaveletTree(text[order - 1], symbols)  # text[-1] is a separator

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + both[:len(symbol)], self.first[symbol] + both[len(symbol):]


def matching_statistics(index: FMIndex, text: np.ndarray, end: np.ndarray, window: int,
                        ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences that end before each position of ``end``: how many words
    back they also occur elsewhere (``window`` at most), and the interval of
    suffixes where that is a whole window."""
    length = np.zeros(len(end), np.int64)
    low, high = np.zeros(len(end), np.int64), np.full(len(end), len(text), np.int64)
    live = np.arange(len(end))
    for back in range(1, window + 1):
        a, b = index.extend(text[end[live] - back], low[live], high[live])
        low[live], high[live] = a, b
        live = live[b - a > 1]  # one occurrence is the sequence itself
        length[live] = back
        if not len(live):
            break
    return length, low, high


def least_ids(segments: pa.Array, ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct segments (bytes of words, each with a space behind) and the
    least id of each -> per window, segment by segment: the least id of all
    segments that hold it; and the count of windows up to each segment."""
    segments = pa.concat_arrays([segments.cast(pa.large_binary())])
    offsets, flat = text_buffers(segments)
    ends = np.flatnonzero(flat == 32) + 1
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(flat)])
    number = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    cut = np.searchsorted(ends, offsets, "right")  # words before each segment
    size = np.diff(cut)
    of_word = np.repeat(np.arange(len(size)), size)
    text = np.zeros(len(number) + len(size), np.int64)
    text[np.arange(len(number)) + of_word] = number
    owner = np.repeat(np.arange(len(size)), size + 1)
    count = size - window + 1
    upto = np.concatenate([[0], np.cumsum(count)])
    of_window = np.repeat(np.arange(len(size)), count)
    begin = (cut[:-1] + np.arange(len(size)))[of_window] + np.arange(upto[-1]) - upto[of_window]
    index = FMIndex(text)
    length, low, high = matching_statistics(index, text, begin + window, window)
    least = ids[of_window].copy()
    found = np.flatnonzero(length == window)
    if len(found):
        low, which = np.unique(low[found], return_inverse=True)
        top = np.zeros(len(low), np.int64)
        top[which] = high[found]
        by_suffix = np.append(ids[owner[index.suffixes]], LAST)
        bounds = np.stack([low, top], 1).ravel()
        least[found] = np.minimum.reduceat(by_suffix, bounds)[::2][which]
    return least, upto


# --- Spark stages ------------------------------------------------------------


def anchors(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of each document, with its group."""
    for batch in batches:
        for part in byte_slices(batch, "text", PART_BYTES):
            w = windows_of(part.column("text"), window, gram)
            doc, anchor = w.doc[w.run], w.anchor[w.run]
            order = np.lexsort((anchor, doc))
            doc, anchor = doc[order], anchor[order]
            new = np.ones(len(doc), bool)
            new[1:] = (np.diff(doc) != 0) | (anchor[1:] != anchor[:-1])
            group = part.column("grp").to_numpy()[doc[new]]
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), pa.array(group)], names=["anchor", "grp"])


def parts_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.combine_chunks().to_batches():
        yield from byte_slices(batch, "text", PART_BYTES)


SEGMENT = "bucket int, grp int, n int, size int, body binary"
ANSWER = "grp int, name1 long, name2 long, offset int, n int, least long, single boolean"


def packed(segments: list[bytes], lo: list[int], hi: list[int], single: list[bool], spread: list[int]) -> tuple[int, bytes]:
    """A letter's body: ids, marks, a byte of the route's hash, and segments,
    compressed (they share most of their words); and its size before."""
    raw = b"".join([np.array(lo, np.int64).tobytes(), np.array(hi, np.int64).tobytes(), np.array(single, np.uint8).tobytes(),
                    np.array(spread, np.uint8).tobytes(), b"\n".join(segments)])
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(n: int, size: int, body: bytes, shard: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """What a letter has for one of the bucket's shards."""
    raw = pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)
    lo, hi = np.frombuffer(raw, np.int64, 2 * n).reshape(2, -1)
    single, spread = np.frombuffer(raw, np.uint8, 2 * n, 16 * n).reshape(2, -1)
    own = np.flatnonzero(spread % shards == shard)
    segments = raw[18 * n:].split(b"\n")
    return lo[own], hi[own], single[own] > 0, [segments[i] for i in own]


def segments_of(docs: pa.Table, repeated: pa.Table, window: int, gram: int, buckets: int) -> pa.Table:
    """A group's letters, one a bucket of routes: its distinct segments, with
    the least and the largest id that has them."""
    found: dict[tuple, list] = {}
    wanted, by = np.unique(repeated.column("anchor").to_numpy().view(np.uint64), return_index=True)
    hot_anchor = repeated.column("n").to_numpy()[by] > HOT_DOCS
    for part in parts_of(docs) if len(wanted) else ():
        w = windows_of(part.column("text"), window, gram)
        if not len(w.start):
            continue
        keys = keys_of(part.column("key"))
        at = np.minimum(np.searchsorted(wanted, w.anchor[w.run]), len(wanted) - 1)
        yes = wanted[at] == w.anchor[w.run]
        hot = yes & hot_anchor[at]
        last = np.append(w.run[1:], len(w.start)) - 1
        body, where = spaced(w)
        runs = np.flatnonzero(yes & ~hot)
        singles = np.flatnonzero(hot[w.run_of])
        a = np.concatenate([w.start[w.run[runs]], w.start[singles]])
        b = np.concatenate([w.start[last[runs]], w.start[singles]]) + window
        route = np.concatenate([w.anchor[w.run[runs]], sequence_names(w.hashes, a[len(runs):], b[len(runs):])[0]])
        place = mix64(route)
        bucket, spread = (place % np.uint64(buckets)).astype(np.int64), (place >> np.uint64(56)).tolist()
        key = np.concatenate([keys[w.doc[w.run[runs]]], keys[w.doc[singles]]])
        for i, (x, y, k, to) in enumerate(zip(where[a].tolist(), where[b].tolist(), key.tolist(), bucket.tolist(), strict=True)):
            name = (to, i >= len(runs), body[x:y])
            entry = found.get(name)
            if entry is None:
                found[name] = [k, k, spread[i]]
            else:
                entry[0], entry[1] = min(entry[0], k), max(entry[1], k)
    letters: dict[int, list] = {}
    for (to, one, segment), (lo, hi, spread) in found.items():
        letters.setdefault(to, []).append((segment, lo, hi, one, spread))
    group = docs.column("grp")[0].as_py() if len(docs) else 0
    bodies = [packed(*map(list, zip(*x, strict=True))) for x in letters.values()]
    cols = [(list(letters), pa.int32()), ([group] * len(letters), pa.int32()), ([len(x) for x in letters.values()], pa.int32()),
            ([n for n, _ in bodies], pa.int32()), ([x for _, x in bodies], pa.binary())]
    return pa.table([pa.array(c, k) for c, k in cols], names=[c.split()[0] for c in SEGMENT.split(", ")])


def answers(letters: list[tuple], window: int, shard: int, shards: int) -> pa.RecordBatch:
    """A bucket's letters -> per group and segment of it, of one shard: the intervals of
    windows whose least id is below an id of the group. (A window that is routed
    alone and a segment of one window never have the same text: an anchor is
    hot for all or for none.)"""
    parts = [unpacked(n, size, body, shard, shards) for _, n, size, body in letters]
    grp = np.repeat(np.array([g for g, *_ in letters], np.int32), [len(p[3]) for p in parts])
    lows, highs, single = (np.concatenate([p[i] for p in parts]) for i in range(3))
    if not len(grp):
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=[c.split()[0] for c in ANSWER.split(", ")])
    coded = pa.array([x for p in parts for x in p[3]], pa.large_binary()).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    lo = np.full(len(coded.dictionary), LAST)
    np.minimum.at(lo, code, lows)
    least, upto = least_ids(coded.dictionary, lo, window)
    offsets, flat = text_buffers(coded.dictionary)
    ends = np.flatnonzero(flat == 32)
    hashes = word_hashes(flat, np.concatenate([[0], ends[:-1] + 1]), ends)
    cut = np.searchsorted(ends, offsets)
    name1, name2 = sequence_names(hashes, cut[:-1], cut[1:])
    # runs of windows with one least id
    segment = np.repeat(np.arange(len(lo)), np.diff(upto))
    new = np.ones(len(least), bool)
    new[1:] = (np.diff(least) != 0) | (np.diff(segment) != 0)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(least)))
    of = segment[start]
    first = np.searchsorted(of, np.arange(len(lo) + 1))
    per_row = np.diff(first)[code]
    row = np.repeat(np.arange(len(code)), per_row)
    run = first[code][row] + np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    useful = least[start[run]] < highs[row]
    row, run = row[useful], run[useful]
    return pa.RecordBatch.from_arrays(
        [pa.array(grp[row]), pa.array(name1[code[row]].view(np.int64)), pa.array(name2[code[row]].view(np.int64)),
         pa.array((start[run] - upto[of[run]]).astype(np.int32)), pa.array(size[run].astype(np.int32)),
         pa.array(least[start[run]]), pa.array(single[row])], names=[c.split()[0] for c in ANSWER.split(", ")])


def search_buckets(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Letters in order of the bucket -> answers, one index a shard."""

    def close(letters: list[tuple]) -> Iterator[pa.RecordBatch]:
        shards = min(256, 1 + sum(size for _, _, size, _ in letters) // SHARD_BYTES)
        for shard in range(shards):
            out = answers(letters, window, shard, shards)
            if len(out):
                yield out

    held: list[tuple] = []
    at = None
    for batch in batches:
        for bucket, *letter in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != at and held:
                yield from close(held)
                held = []
            at = bucket
            held.append(tuple(letter))
    if held:
        yield from close(held)


def window_keys(name1: np.ndarray, name2: np.ndarray, offset: np.ndarray, single: np.ndarray | bool) -> np.ndarray:
    return mix64(name1 + mix64(name2 + offset.astype(np.uint64) * np.uint64(2) + np.asarray(single).astype(np.uint64)))


RESULT = "key long, n_words long, removed array<struct<start:int,end:int>>, kept string"


def cut_group(docs: pa.Table, mail: pa.Table, window: int, gram: int) -> pa.Table:
    """The group's documents without the words that the answers cover."""
    n = mail.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    of = lambda c: mail.column(c).to_numpy()[row]
    single = mail.column("single").to_numpy(zero_copy_only=False)[row].astype(bool)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    known = window_keys(of("name1").view(np.uint64), of("name2").view(np.uint64), of("offset") + step, single)
    order = np.argsort(known)
    known, least = known[order], of("least")[order]
    out = []
    for part in parts_of(docs):
        w = windows_of(part.column("text"), window, gram)
        keys = keys_of(part.column("key"))
        covered = np.zeros(len(w.s) + 1, np.int64)

        def mark(names: np.ndarray, w=w, keys=keys, covered=covered) -> None:
            at = np.minimum(np.searchsorted(known, names), len(known) - 1)
            hit = np.flatnonzero((known[at] == names) & (least[at] < keys[w.doc]))
            np.add.at(covered, w.start[hit], 1)
            np.add.at(covered, w.start[hit] + window, -1)

        if len(known) and len(w.start):
            last = np.append(w.run[1:], len(w.start)) - 1
            a, b = sequence_names(w.hashes, w.start[w.run], w.start[last] + window)
            mark(window_keys(a[w.run_of], b[w.run_of], w.offset, False))
            if single.any():
                a, b = sequence_names(w.hashes, w.start, w.start + window)
                mark(window_keys(a, b, np.zeros(len(a), np.int64), True))
        gone = np.cumsum(covered[:-1]) > 0
        body, where = spaced(w)
        removed, kept = [], []
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            own = gone[a:b]
            if not own.any():
                removed.append([])
                kept.append(body[where[a]:max(where[a], where[b] - 1)])
                continue
            edge = np.flatnonzero(np.diff(own, prepend=False, append=False)).reshape(-1, 2)
            removed.append([{"start": x, "end": y} for x, y in edge.tolist()])
            stay = np.flatnonzero(np.diff(~own, prepend=False, append=False)).reshape(-1, 2) + a
            kept.append(b"".join([body[where[x]:where[y]] for x, y in stay.tolist()])[:-1])
        spans = pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        out.append(pa.table([part.column("key"), pa.array(np.diff(w.first)), spans, pa.array(kept, pa.binary()).cast(pa.string())],
                            names=["key", "n_words", "removed", "kept"]))
    return pa.concat_tables(out)


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per row: key, n_words, removed (spans of word positions), kept (the other
    words, joined by one space)."""
    if not 1 <= gram <= window <= 16:
        raise ValueError("a gram must not exceed a window, nor a window 16 words")
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "grp", F.pmod(F.xxhash64("key", "text"), F.lit(GROUPS * n)).cast("int"))
    seen = rows.mapInArrow(lambda it: anchors(it, window, gram), "anchor long, grp int")
    often = seen.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = seen.join(often, "anchor").select("grp", "anchor", "n")
    grouped = rows.groupBy("grp")
    segments = grouped.cogroup(repeated.groupBy("grp")).applyInArrow(
        lambda d, r: segments_of(d, r, window, gram, BUCKETS * n), SEGMENT)
    answered = (segments.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket")
                .mapInArrow(lambda it: search_buckets(it, window), ANSWER))
    return (rows.groupBy("grp").cogroup(answered.groupBy("grp"))
            .applyInArrow(lambda d, m: cut_group(d, m, window, gram), RESULT).withColumnRenamed("key", key))
