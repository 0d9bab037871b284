"""Exact dedup (operator 6): an extendible-hash index on shared files.

1. Scan: each task folds copies of a text that it meets into one row (largest
   id, count), so that a hot text costs a few rows a task, not one a copy.
2. Owner tasks: the 64-bit hash space is cut into as many equal key ranges as
   there are shuffle partitions; ``repartitionById`` sends a range to its
   owner, which reads it in key order. Texts under one hash form a chain and
   are compared byte for byte, so a collision only lengthens a chain.
3. Each owner puts its entries into an extendible hash table: a full bucket
   splits by one more hash bit, and the directory doubles when a bucket is as
   deep as the directory itself. A bucket whose entries all share one hash
   can't be split and simply grows its chain.
4. The buckets are written as Parquet below spark.checkpoint.dir, where every
   executor sees them; a lost executor's range is written again by Spark.
5. Lookup: every row meets its index entry by (hash, SHA-256). Copies of a hot
   text on the row side are left to the skew join; the index has one row a text.

Null counts as the empty text. Ids compare as numbers; a null id is smaller
than all others, so its row only stays where no row of the text has an id.
Rows that repeat an id and a text are one document: each returns a row, all
are marked alike, and ``kept_rows`` keeps one of them. Empty tables give no
rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, frugal, shuffle_partitions, written

#: Entries a bucket holds before it splits.
BUCKET_ENTRIES = 1024
#: Bytes of distinct texts that a scan task remembers at a time.
FOLD_BYTES = 48 << 20

INDEX = ("owner int, directory_depth int, bucket int, bucket_depth int, hash long, chain int, "
         "text_sha256 string, keep_id long, group_size long, keep_rows long")


class ExtendibleTable:
    """In-task extendible hash table from a 64-bit hash to a chain of entries."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.depth = 0
        self.directory: list[dict] = [{"depth": 0, "prefix": 0, "chains": {}, "n": 0}]

    def chain(self, h: int) -> list:
        """The entries under ``h`` (an empty chain is made when there is none)."""
        bucket = self.directory[h & ((1 << self.depth) - 1)]
        return bucket["chains"].setdefault(h, [])

    def added(self, h: int) -> None:
        """Count a new entry under ``h`` and split its bucket while overfull."""
        bucket = self.directory[h & ((1 << self.depth) - 1)]
        bucket["n"] += 1
        while bucket["n"] > self.capacity and len(bucket["chains"]) > 1 and bucket["depth"] < 32:
            if bucket["depth"] == self.depth:
                self.directory = self.directory * 2
                self.depth += 1
            bit = 1 << bucket["depth"]
            halves = [{"depth": bucket["depth"] + 1, "prefix": bucket["prefix"] | side, "chains": {}, "n": 0}
                      for side in (0, bit)]
            for k, entries in bucket["chains"].items():
                half = halves[bool(k & bit)]
                half["chains"][k] = entries
                half["n"] += len(entries)
            for slot in range(bucket["prefix"], len(self.directory), bit):
                self.directory[slot] = halves[bool(slot & bit)]
            bucket = self.directory[h & ((1 << self.depth) - 1)]

    def buckets(self) -> Iterator[dict]:
        for slot, bucket in enumerate(self.directory):
            if slot == bucket["prefix"]:
                yield bucket


def larger(a: int | None, b: int | None) -> bool:
    return a is not None and (b is None or a > b)


def fold_id(entry: list, key: int | None, n: int, top: int) -> None:
    """entry: [key, n, top]; n counts rows, top those that carry the key."""
    entry[1] += n
    if larger(key, entry[0]):
        entry[0], entry[2] = key, top
    elif key == entry[0]:
        entry[2] += top


def fold_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, list] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        texts = list(seen)
        out = pa.RecordBatch.from_arrays(
            [pa.array([e[3] for e in seen.values()], pa.int64()), pa.array(texts, pa.string()),
             *(pa.array([e[i] for e in seen.values()], pa.int64()) for i in range(3))],
            names=["hash", "text", "key", "n", "top"])
        seen.clear()
        return out

    for batch in batches:
        for part in byte_slices(batch, "text", FOLD_BYTES // 4):
            for h, text, key in zip(*(part.column(c).to_pylist() for c in ("hash", "text", "key")), strict=True):
                if (entry := seen.get(text)) is None:
                    seen[text] = [key, 1, 1, h]
                    held += 4 * len(text) if not text.isascii() else len(text)
                else:
                    fold_id(entry, key, 1, 1)
            if held > FOLD_BYTES:
                yield from byte_slices(flush(), "text", FOLD_BYTES // 4)
                held = 0
    if seen:
        yield from byte_slices(flush(), "text", FOLD_BYTES // 4)


def own_range(capacity: int) -> Callable:
    """One owner's rows, in hash order -> its buckets' entries."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, owner = ExtendibleTable(capacity), 0
        at, texts, chain = None, [], []
        for batch in batches:
            for part in byte_slices(batch, "text", FOLD_BYTES // 4):
                cols = [part.column(c).to_pylist() for c in ("owner", "hash", "text", "key", "n", "top")]
                for owner, h, text, key, n, top in zip(*cols, strict=True):
                    if h != at:
                        at, texts, chain = h, [], table.chain(h & 0xFFFFFFFFFFFFFFFF)
                    if text in texts:  # compares the bytes along the chain
                        fold_id(chain[texts.index(text)], key, n, top)
                        continue
                    texts.append(text)
                    chain.append([key, n, top, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()])
                    table.added(h & 0xFFFFFFFFFFFFFFFF)
        for bucket in table.buckets():
            rows = [(owner, table.depth, bucket["prefix"], bucket["depth"], h - (h >> 63 << 64), i, e[3], e[0], e[1], e[2])
                    for h, entries in bucket["chains"].items() for i, e in enumerate(entries)]
            if rows:
                kinds = [pa.int32()] * 4 + [pa.int64(), pa.int32(), pa.string()] + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=[c.split()[0] for c in INDEX.split(", ")])

    return build


def text_index(docs: DataFrame, key: str = "doc_id", text: str | Column = "text",
               bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """The written index of the distinct texts: one row per entry (columns
    ``INDEX``), buckets of an owner together in that owner's file."""
    n = shuffle_partitions(docs.sparkSession)
    col = F.col(text) if isinstance(text, str) else text
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(col, F.lit("")).alias("text"))
    folded = (rows.withColumn("hash", F.xxhash64("text"))
              .mapInArrow(frugal(fold_copies), "hash long, text string, key long, n long, top long"))
    high = F.shiftrightunsigned("hash", 40)  # 24 bits: equal ranges of the unsigned hash
    owned = (folded.withColumn("owner", F.shiftright(high * F.lit(n), 24).cast("int"))
             .repartitionById(n, "owner").sortWithinPartitions("hash"))
    return written(owned.mapInArrow(frugal(own_range(bucket_entries)), INDEX), "text-index")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str | Column = "text",
                 bucket_entries: int = BUCKET_ENTRIES, index: DataFrame | None = None) -> DataFrame:
    """All columns of ``docs`` plus keep_id, group_size, kept, text_sha256 and
    keep_rows (rows that carry the kept id and text). Columns of ``docs`` with
    these names are replaced. ``index``: of these rows, if it is there already."""
    col = F.col(text) if isinstance(text, str) else text
    new = ["keep_id", "group_size", "kept", "text_sha256", "keep_rows", "_hash"]
    whole = F.coalesce(col, F.lit(""))
    left = docs.drop(*[c for c in new if c not in (key, text)]).withColumns(
        {"_hash": F.xxhash64(whole), "text_sha256": F.sha2(whole.cast("binary"), 256)})
    index = text_index(docs, key, text, bucket_entries) if index is None else index
    entries = index.select(F.col("hash").alias("_hash"), "text_sha256", "keep_id", "group_size", "keep_rows")
    return (left.join(entries, ["_hash", "text_sha256"])
            .withColumn("kept", F.col(key).cast("long").eqNullSafe(F.col("keep_id"))).drop("_hash"))


def kept_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.struct("*").alias("_row"))
    index = text_index(rows, "_key", "_text")
    kept = exact_groups(rows, "_key", "_text", index=index).filter("kept")
    if index.filter("keep_rows > 1").isEmpty():
        return kept.select("_row.*")
    once = kept.filter("keep_rows = 1").select("_row.*")
    repeated = kept.filter("keep_rows > 1").dropDuplicates(["_key", "text_sha256"]).select("_row.*")
    return once.unionAll(repeated)
