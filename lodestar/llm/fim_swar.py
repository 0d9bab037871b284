"""Fill-in-the-middle transformation (operator 12): cut points by SWAR words.

A text is cut into units (lines with their line feed) at two hashed unit
counts, and its three parts are rearranged around sentinels. The UTF-8 bytes
of an Arrow batch are viewed as 64-bit words, eight bytes a word. The bytes
that end a unit are marked arithmetically, as are the bytes that begin a code
point; ``bitwise_count`` gives the marks of a word and a running sum those
before it. The end of a text's k-th unit is then a search of the running sum
for the word, and a select inside the word that clears its lowest marks. So a
text is never split into a list of units: the work is a few passes over
its words, and memory a few times its bytes (parts of ``PART_BYTES``; a longer
text is a part of its own).

Cuts depend on the id and the text alone, so repeated rows agree and reruns do
too. Null texts are empty, a null id is written as nothing; empty texts and
texts that hold a sentinel are left as they are (form ``plain``). Empty tables
give no rows. Only the id and text columns are read: further columns, whatever
their names, don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, frugal, text_buffers

#: Sentinels before prefix, suffix and middle. Fixed by the query contract.
SENTINELS = ("<P>", "<S>", "<M>")
PART_BYTES = 4 << 20
LINE_FEED = 10

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW = ~HIGH


def as_words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, the last one filled up with zeros."""
    whole = len(data) >> 3
    words = np.empty(whole + 1, "<u8")
    words[:whole] = data[:whole << 3].view("<u8")
    last = np.zeros(8, np.uint8)
    last[:len(data) & 7] = data[whole << 3:]
    words[whole] = last.view("<u8")[0]
    return words


def mark_byte(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of every byte that equals ``byte`` (none else: no carry
    leaves a byte)."""
    x = words ^ (ONES * np.uint64(byte))
    return ~(((x & LOW) + LOW) | x) & HIGH


def mark_continuation(words: np.ndarray) -> np.ndarray:
    """The high bit of every UTF-8 continuation byte (10......)."""
    return words & ~(words << np.uint64(1)) & HIGH


class Marks:
    """Rank and select over the marked bytes of words."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.sums = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.sums[1:])

    def before(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each byte position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte << np.uint64(3))) - np.uint64(1)
        return self.sums[word] + np.bitwise_count(self.marks[word] & below)

    def position(self, rank: np.ndarray) -> np.ndarray:
        """The byte position of the mark that has ``rank`` marks before it."""
        word = np.searchsorted(self.sums, rank, "right") - 1
        left, marks = rank - self.sums[word], self.marks[word]
        for k in range(1, 8):  # a word has eight marks at most
            marks = np.where(left >= k, marks & (marks - np.uint64(1)), marks)
        lowest = marks & (~marks + np.uint64(1))
        return (word << 3) + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


class Units:
    """Units of consecutive texts, ended by a line feed or the text's end."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        words = as_words(data)
        self.offsets = offsets
        self.ends = Marks(mark_byte(words, LINE_FEED))
        self.within = Marks(mark_continuation(words))
        start, stop = offsets[:-1], offsets[1:]
        self.first = self.ends.before(start)
        self.fed = self.ends.before(stop) - self.first
        open_end = np.zeros(len(start), bool)
        full = stop > start
        open_end[full] = data[stop[full] - 1] != LINE_FEED
        self.count = self.fed + open_end

    def end_of(self, units: np.ndarray) -> np.ndarray:
        """Per text the byte position after its first ``units`` units."""
        out = self.offsets[:-1].copy()
        fed = (units > 0) & (units <= self.fed)
        out[fed] = self.ends.position((self.first + units - 1)[fed]) + 1
        rest = units > self.fed
        out[rest] = self.offsets[1:][rest]
        return out

    def chars(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Code points between byte positions."""
        return stop - start - (self.within.before(stop) - self.within.before(start))


def draws(keys: Sequence[object], seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers per id, of the sha256 of ``seed:id``."""
    out = [hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).digest()[:16] for k in keys]
    return np.frombuffer(b"".join(out), ">u4").reshape(-1, 4).astype(np.int64)


def rearranged(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, fim_percent: int = 100,
               spm_percent: int = 50, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per row: key, n (units), form (plain, spm, psm), prefix_chars,
    middle_chars (null if plain), output (the rearranged text)."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    before_prefix, before_suffix, before_middle = (s.encode() for s in SENTINELS)

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        texts, keys = part.column("text"), part.column("key")
        offsets, data = text_buffers(texts)
        units, h = Units(offsets, data), draws(keys.to_pylist(), seed)
        n = units.count
        a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
        start, one, two, stop = offsets[:-1], units.end_of(np.minimum(a, b)), units.end_of(np.maximum(a, b)), offsets[1:]
        plain = (n == 0) | (h[:, 2] % 100 >= fim_percent)
        for s in SENTINELS:
            plain |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        spm = h[:, 3] % 100 < spm_percent
        raw, out = memoryview(data), []
        for i, (p, q, r, s) in enumerate(np.stack([start, one, two, stop], 1).tolist()):
            if plain[i]:
                out.append(bytes(raw[p:s]))
            elif spm[i]:
                out.append(b"".join((before_suffix, raw[r:s], before_prefix, raw[p:q], before_middle, raw[q:r])))
            else:
                out.append(b"".join((before_prefix, raw[p:q], before_suffix, raw[r:s], before_middle, raw[q:r])))
        form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(n), pa.array(form.tolist(), pa.string()),
             pa.array(units.chars(start, one), mask=plain), pa.array(units.chars(one, two), mask=plain),
             pa.array(out, pa.binary()).view(pa.string())],
            names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", part_bytes):
                yield cut(part)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(frugal(run), schema).withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text that ``rearranged`` had, from its output and form. A text
    without sentinels can't make one where it meets a sentinel, so the first
    occurrence of each is the one that was put there."""
    parts = F.split(output, "|".join(SENTINELS), 4)  # what stands before and after the three sentinels
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
