"""Packing (operator 13): documents along a space-filling curve, end to end.

A document's token ids, hashed, are projected to ``DIMENSIONS`` coordinates
(the mean of fixed pseudo-random vectors), which lie in a fixed cube whatever
the corpus. Their Hilbert key, with a hash of the id below it, is the
document's place: near documents get near places, and equal ones are spread
over many. The written documents are range-sorted by place (bounds from a
sample of places, which balances work only), the tokens before each range are
summed, and each range lays its documents end to end from there. Every
``length`` tokens a sequence ends, so a document is cut only where a sequence
is full and no token is padding but those after the last one; with
``powers``, the tokens left at the end are sequences of descending powers of
two, and there is no padding at all.

Encoding asks the tokenizer for each distinct piece of a task once. Its rules
drop white space, so a text's ids are those of its words in turn; a word of
plain Latin letters, digits and ASCII marks is cut further into the pieces
that the rules cut it into, each a single call of the tokenizer's model. Other
words are encoded whole, and for a tokenizer with other rules whole texts.

Null and empty texts are the closing id alone. Long texts are encoded in
pieces of about ``PART_BYTES`` that end before a word; one unbroken run of
characters is handed to the tokenizer whole. Repeated rows are documents of
their own and lie side by side or apart; which of two equal rows comes first
is not told. Empty tables give no rows. Only id and text are read: further
columns, whatever their names, don't matter.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, frugal, is_space, mix64, shuffle_partitions, text_buffers, written

LENGTH = 2048
#: The id after each document's own. Fixed by the query contract.
CLOSING = 1
DIMENSIONS = 4
LEVELS = 11
#: Coordinates are means of numbers in [-1, 1]; the cube reaches to 1 / SPREAD.
SPREAD = 4.0
HASHED = 1 << 12
PART_BYTES = 8 << 20
#: Pieces remembered between parts of a task (a bound on memory, not on work).
MEMORY = 400_000
#: Places sampled per range.
SAMPLED = 64

#: The rules under which words are encoded on their own: the tokenizer file's
#: pattern and normalizers. Fixed values, of the public vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: A normal piece that the pattern matches as a whole (U+00DF to U+00FF but for
#: the division sign are letters; an apostrophe may begin a match of its own,
#: and "<" an added token).
SIMPLE = re.compile(r"[a-z\u00DF-\u00F6\u00F8-\u00FF]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)


def byte_classes() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    kind[33:127] = MARK
    kind[48:58] = DIGIT
    kind[[*range(65, 91), *range(97, 123)]] = LETTER
    kind[[ord("'"), ord("<")]] = OTHER
    kind[[32, *range(9, 14)]] = SPACE
    return kind


CLASSES = byte_classes()


def drops_space(spec: dict) -> bool:
    """Whether a tokenizer file has those rules."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (len(steps) == 2 and steps[0].get("pattern") == {"Regex": PATTERN} and steps[0].get("behavior") == "Removed"
            and steps[0].get("invert") is True and steps[1].get("type") == "ByteLevel"
            and not steps[1].get("add_prefix_space") and steps[1].get("use_regex") is False
            and (spec.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and all(t["content"][0] == "<" and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                    for t in spec.get("added_tokens", [])))


class Encoder:
    """Token ids of texts by a tokenizer file, each piece asked for once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.by_word = drops_space(json.load(f))
        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[bytes, bytes] = {}

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ask(self, piece: bytes) -> bytes:
        """Ids of a piece, packed as unsigned 32-bit numbers."""
        text = piece.decode("utf-8", "replace")
        if not self.by_word or SIMPLE.fullmatch(text) is None:
            return array("I", self.plain(text)).tobytes()
        if not text.isascii():
            text = self.level.pre_tokenize_str(text)[0][0]  # the model's letters for the bytes
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def pieces(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes without white space, starts of the pieces in them, index of
        each text's first piece and of the end)."""
        kind = CLASSES[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        second = data[lead + 1]
        lead = lead[(second != 0x97) & (second != 0xB7)]  # the signs of multiplication and division are no letters
        kind[lead] = kind[lead + 1] = LETTER
        inside = kind != SPACE
        opens = np.empty(len(data), bool)  # words, then pieces
        opens[:1] = True
        opens[1:] = ~inside[:-1]
        at = offsets[:-1][offsets[:-1] < len(data)]
        opens[at] = True
        opens &= inside
        first = np.flatnonzero(opens)
        word = np.cumsum(opens) - 1
        hard = np.zeros(len(first), bool)
        hard[word[kind == OTHER]] = True
        easy = inside & ~hard[word] if len(first) else inside
        low = data.copy()
        low[easy & (data >= 65) & (data <= 90)] += 32
        capital = lead[easy[lead] & (data[lead + 1] <= 0x9E)] + 1
        low[capital] += 32
        turn = easy & (kind == DIGIT)
        turn[1:] |= easy[1:] & (kind[1:] != kind[:-1])
        opens |= turn
        kept = np.concatenate([[0], np.cumsum(inside)])
        starts = kept[np.flatnonzero(opens)]
        return low[inside], starts, np.searchsorted(starts, kept[offsets])

    def part(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, one after another, and each text's end."""
        if self.by_word and len(data):
            data, starts, texts = self.pieces(offsets, data)
        else:
            starts = np.unique(offsets)[:-1]
            texts = np.searchsorted(starts, offsets)
        cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = cells.dictionary_encode()
        each, fresh = [], {}
        for piece in coded.dictionary.to_pylist():
            ids = self.known.get(piece)
            if ids is None:
                ids = fresh[piece] = self.ask(piece)
            each.append(ids)
        if len(self.known) + len(fresh) > MEMORY:
            self.known.clear()
        self.known.update((w, ids) for w, ids in islice(fresh.items(), MEMORY) if len(w) <= 64)
        sizes = np.fromiter(map(len, each), np.int64, len(each)) >> 2
        flat, first = np.frombuffer(b"".join(each), np.uint32), np.cumsum(sizes) - sizes
        code = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[code])])
        ids = flat[np.repeat(first[code] - ends[:-1], sizes[code]) + np.arange(ends[-1])]
        return ids, ends[texts[1:]]

    def texts(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``part``; a long text in parts that end before white space."""
        if len(offsets) != 2 or not self.by_word or len(data) <= 2 * PART_BYTES:
            return self.part(offsets, data)
        out, at = [], 0
        while at < len(data):
            stop = min(at + PART_BYTES, len(data))
            while stop < len(data):
                space = np.flatnonzero(is_space(data[stop:stop + PART_BYTES]))
                if len(space):
                    stop += int(space[0])
                    break
                stop = min(stop + PART_BYTES, len(data))
            out.append(self.part(np.array([0, stop - at]), data[at:stop])[0])
            at = stop
        ids = np.concatenate(out)
        return ids, np.array([len(ids)])


def directions(seed: int, vocabulary: int) -> np.ndarray:
    """For each token, the fixed pseudo-random vector in [-1, 1] of its hash."""
    x = mix64(np.arange(HASHED * DIMENSIONS, dtype=np.uint64) + np.uint64(seed << 32))
    vectors = (x.astype(np.float64) / 2.0**63 - 1.0).reshape(HASHED, DIMENSIONS)
    return vectors[(mix64(np.arange(vocabulary, dtype=np.uint64)) & np.uint64(HASHED - 1)).astype(np.int64)]


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits`` bits a coordinate
    (rows: points): undo the curve's turns from the highest bit down, Gray-code,
    and deal the bits of the coordinates in turn."""
    x = [c.copy() for c in cells.astype(np.int64).T]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = np.int64(1 << level), np.int64((1 << level) - 1)
        for i in range(n):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), np.int64((1 << level) - 1), 0)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ flip) >> level & 1)
    return key


def curve_keys(ids: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert key of each document, from its ids (documents end at ``ends``)."""
    counts = np.diff(ends, prepend=0)
    x = np.zeros((len(ends), DIMENSIONS))
    for d in range(DIMENSIONS):
        sums = np.concatenate([[0.0], np.cumsum(table[ids, d])])
        x[:, d] = (sums[ends] - sums[ends - counts]) / np.maximum(counts, 1)
    side = 1 << LEVELS
    cells = np.clip(np.floor((x * SPREAD + 1.0) * (side / 2)), 0, side - 1).astype(np.int64)
    return hilbert(cells, LEVELS)


def encoded(docs: DataFrame, tokenizer: str, key: str, text: str, closing: int, seed: int) -> DataFrame:
    """key, rid, place, n (with the closing id), ids (little-endian, the
    closing one left out; 16 bits each where the vocabulary allows)."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        table = directions(seed, encoder.tokenizer.get_vocab_size())
        for batch in batches:
            for part in byte_slices(batch, "text", PART_BYTES, 1 << 13):
                ids, ends = encoder.texts(*text_buffers(part.column("text")))
                keys = curve_keys(ids, ends, table)
                packed = ids.astype("<u4").view(np.uint8)
                if len(ids) == 0 or ids.max() < 1 << 16:
                    packed = ids.astype("<u2").view(np.uint8)
                wide = len(packed) // max(len(ids), 1)
                cells = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(ends), 
                    [None, pa.py_buffer(np.concatenate([[0], ends]) * wide), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(keys), pa.array(np.diff(ends, prepend=0) + 1), cells.cast(pa.binary())],
                    names=["key", "curve", "n", "ids"])

    out = rows.mapInArrow(frugal(run), f"key {rows.schema['key'].dataType.simpleString()}, curve long, n long, ids binary")
    low = 63 - DIMENSIONS * LEVELS
    out = out.withColumn("rid", F.monotonically_increasing_id())
    return out.withColumn("place", F.shiftleft("curve", low).bitwiseOR(
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), "key", "rid"), 64 - low)))


def sequence_bounds(total: int, length: int, powers: bool) -> np.ndarray:
    """Where sequences start after the last full one, and the end of all tokens."""
    at, out = total // length * length, []
    while at < total:
        out.append(at)
        at += 1 << (total - at).bit_length() - 1 if powers else total - at
    return np.array([*out, total], np.int64)


def pieces_of(start: np.ndarray, n: np.ndarray, length: int, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of documents at ``start`` with ``n`` tokens: per piece the document, its
    first position, its length, its sequence and the position there."""
    full = int(last[0])

    def sequence(at: np.ndarray) -> np.ndarray:
        return np.where(at < full, at // length, full // length + np.searchsorted(last, at, "right") - 1)

    first, final = sequence(start), sequence(start + n - 1)
    count = final - first + 1
    doc = np.repeat(np.arange(len(n)), count)
    seq = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count - first, count)

    def opening(seq: np.ndarray) -> np.ndarray:
        late = seq - full // length
        return np.where(late < 0, seq * length, last[np.clip(late, 0, len(last) - 1)])

    a = np.maximum(opening(seq), start[doc])
    b = np.minimum(opening(seq + 1), (start + n)[doc])
    return doc, a - start[doc], b - a, seq, a - opening(seq)


def packed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
           closing: int = CLOSING, powers: bool = True, seed: int = 13) -> DataFrame:
    """Per piece: key, start (ids of its document before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    rows = written(encoded(docs, tokenizer, key, text, closing, seed), "pack-ids")
    size, total = rows.agg(F.count("*"), F.sum("n")).first()
    share = min(1.0, SAMPLED * n / max(size, 1))
    chosen = F.pmod(F.xxhash64(F.lit(seed + 1), "rid"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = np.sort(np.array([r.place for r in rows.filter(chosen).select("place").collect()], np.int64))
    bounds = np.unique(sample[(np.arange(1, n) * len(sample)) // n]) if len(sample) else np.zeros(0, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            task = np.searchsorted(bounds, batch.column("place").to_numpy(), "right")
            yield batch.append_column("task", pa.array(task, pa.int32()))

    def dealt(columns: list[str]) -> DataFrame:
        some = rows.select(*columns)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in some.schema) + ", task int"
        return some.mapInArrow(deal, schema)

    tokens = np.zeros(len(bounds) + 2, np.int64)
    for r in dealt(["place", "n"]).groupBy("task").agg(F.sum("n").alias("n")).collect():  # a row a range
        tokens[r.task + 1] = r.n
    before, last = np.cumsum(tokens), sequence_bounds(total or 0, length, powers)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, task = 0, -1
        for batch in batches:
            for some in byte_slices(batch, "ids", PART_BYTES):
                sizes, tasks = some.column("n").to_numpy(), some.column("task").to_numpy()
                ends = np.cumsum(sizes)
                start = ends - sizes
                for t in np.unique(tasks):
                    own = np.flatnonzero(tasks == t)
                    base = at if t == task else int(before[t])
                    start[own] += base - start[own[0]]
                    task, at = t, int(start[own[-1]] + sizes[own[-1]])
                doc, first, count, seq, offset = pieces_of(start, sizes, length, last)
                where, data = text_buffers(some.column("ids"))
                wide = np.diff(where) // np.maximum(sizes - 1, 1)
                ids = np.full(int(ends[-1]) if len(ends) else 0, closing, "<u4")
                inner = np.ones(len(ids), bool)
                inner[ends - 1] = False
                if (wide == 4).any():  # a part of the table has wide ids
                    ids[inner] = np.concatenate([data[a:b].view("<u4" if w == 4 else "<u2")
                                                 for a, b, w in zip(where, where[1:], wide, strict=False)])
                else:
                    ids[inner] = np.ascontiguousarray(data).view("<u2")
                stops = np.cumsum(count)  # pieces tile the ids in turn
                cells = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(doc), [None, pa.py_buffer(np.concatenate([[0], stops]) * 4), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [some.column("key").take(pa.array(doc)), pa.array(first), pa.array(count), cells.cast(pa.binary()),
                     pa.array(sizes[doc]), pa.array(seq), pa.array(offset)],
                    names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = rows.schema["key"].dataType.simpleString()
    along = (dealt(["key", "rid", "place", "n", "ids"]).repartitionById(n, "task")
             .sortWithinPartitions("task", "place", "key", "rid"))
    return along.mapInArrow(frugal(lay), f"key {kind}, start long, length long, ids binary, doc_tokens long, "
                            "sequence_id long, offset long").withColumnRenamed("key", key)
