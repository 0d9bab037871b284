"""Helpers shared by the corpus operators: Arrow batches, words, written tables."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import scratch_path

#: Characters between words: space and 0x09-0x0D. Fixed by the query contracts.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: of '')."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back.

    This cuts lineage and survives lost executors: every executor sees the
    files, so nothing upstream is computed twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@functools.cache
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def frugal(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``f`` for mapInArrow; its freed memory goes back to the system at the
    end of each task, as Python workers stay for the tasks of later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return run


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets int64, bytes uint8) of a string or binary array; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n, bufs = len(texts), texts.buffers()  # read in place: batches can be large
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.dtype(np.int64 if wide else np.int32)
    offsets = np.frombuffer(bufs[1], kind, n + 1, texts.offset * kind.itemsize).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def byte_slices(batch: pa.RecordBatch, column: str, limit: int, rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about ``limit`` bytes of text (a
    longer single text is a part of its own) and at most ``rows`` rows."""
    n = batch.num_rows
    if not n:
        return
    offsets, _ = text_buffers(batch.column(column))
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), start + rows, n)
        yield batch.slice(start, stop - start)
        start = stop


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of consecutive texts: (start, end) byte positions and, per text,
    the index of its first word (length texts + 1)."""
    inside = ~is_space(data)
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    starts = inside & ~before
    starts[edges] |= inside[edges]          # a text starts a new word
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = inside & ~after
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] |= inside[last]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, offsets)


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, base: int = 0x9E3779B97F4A7C15 | 1,
                ) -> np.ndarray:
    """64-bit hash of each word (equal words have equal hashes wherever they
    stand): a polynomial over the bytes, by prefix sums, then mixed."""
    if not len(s):
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data)), out=sums[1:])
    h = (sums[e] - sums[s]) * powers(inverse, len(data))[s]
    return mix64(h + mix64((e - s).astype(np.uint64)))
