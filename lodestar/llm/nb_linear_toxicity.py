"""Toxicity (operator 10): linear classifier over character n-grams, scaled by
naive Bayes log-count ratios.

Features: whether a hashed character n-gram (orders ``ORDERS``, A-Z and other
letters lower-cased as Python does) occurs in the whole text. Their document
counts by class come from all labelled training rows, summed per task before
the shuffle; the log-count ratio of the smoothed shares scales each feature,
and features whose ratio is less than ``MIN_Z`` standard errors from zero are
left out. The linear weights are a logistic regression on scaled features,
fitted in one task on a sample of about ``fit_rows`` training rows of each class
(those of the smallest hash of id and text; equal rows are drawn as one, with
their number as weight, at most their share): the one bounded part. Rows are
weighted by the size of their class. Margins are calibrated on folds of that
sample whose own counts are taken out of the ratios; if a fold leaves no row of
a class (fewer than two in all), the ratios themselves are the weights.
A bitmap of 2**FILTER_BITS bits, of the labelled ids' hashes, keeps most
unlabelled texts out of the join with the labels. Scoring reads every text with a model of 2**bits weights, whatever the
corpus.

Null and empty texts have no features: their score is the calibrated bias. Long
texts are read in overlapping pieces of ``PIECE`` characters, whole. A
label that is null is no label; a document with several label rows counts once
for each; ids that are null have no label. Without training rows of both
classes every score is the smoothed share of label 1. Empty tables give no
rows. Only id, text and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, fold, frugal, mix64, shuffle_partitions, written
from lodestar.llm.linear import Blocks, Stack, calibrate, fit_logistic, sigmoid

ORDERS = (4, 5, 6)
BITS = 20
FIT_ROWS = 16_384
SMOOTHING = 1.0
MIN_Z = 3.0
L2 = 3e-4
FOLDS = 3
PART_BYTES = 1 << 18
PIECE = 1 << 16
FILTER_BITS = 26
BLOCK = 1 << 12
THRESHOLD = 0.3


def buckets_of(texts: list[str], bits: int, wanted: np.ndarray | None) -> np.ndarray:
    """Sorted distinct (text << bits | bucket) of the n-grams of some pieces."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(t) for t in texts])
    points[(points == 9) | (points == 10) | (points == 13)] = 32
    text = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    gram = np.zeros(len(points), np.uint64)
    found = []
    for order in range(1, max(ORDERS) + 1):  # of the n-gram that ends at a character
        gram[order - 1:] += points[:max(0, len(points) - order + 1)] * np.uint64(pow(0x9E3779B97F4A7C15, order, 1 << 64))
        if order in ORDERS and len(points) >= order:
            bucket = (mix64(gram[order - 1:] + np.uint64(order)) >> np.uint64(64 - bits)).astype(np.int64)
            good = text[order - 1:] == text[:len(text) - order + 1]
            if wanted is not None:
                good &= wanted[bucket]
            found.append(text[order - 1:][good] << bits | bucket[good])
    keys = np.concatenate(found) if found else np.zeros(0, np.int64)
    keys.sort()
    return keys[np.flatnonzero(np.diff(keys, prepend=-1))] if len(keys) else keys


def features(texts: list[str], bits: int, wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """Per text the sorted distinct buckets of its n-grams (only those that
    ``wanted`` marks); the ends of a text count as a space. A text of over
    ``PIECE`` characters is read in pieces that overlap by an n-gram."""
    texts = [f" {t.lower()} " for t in texts]
    short = [t if len(t) <= PIECE else "" for t in texts]
    keys = buckets_of(short, bits, wanted)
    cuts = np.searchsorted(keys, np.arange(len(texts) + 1) << bits)
    out = [keys[a:b] & ((1 << bits) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    for i, t in enumerate(texts):
        if len(t) > PIECE:
            marks = np.zeros(1 << bits, bool)
            for at in range(0, len(t), PIECE):
                marks[buckets_of([t[max(0, at - max(ORDERS) + 1):at + PIECE]], bits, wanted)] = True
            out[i] = np.flatnonzero(marks)
    return out


def ratios(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratio of each feature (zero where it never occurred) and its
    size in standard errors."""
    share = n_pos / (n_pos + n_neg)
    p, q = pos + SMOOTHING * share, neg + SMOOTHING * (1 - share)
    r = np.log(p / n_pos) - np.log(q / n_neg)
    return r, np.abs(r) / np.sqrt(1 / p + 1 / q)


def class_counts(training: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents per feature in class 1 and class 0, over all training rows.
    A task sends its sums in blocks, high bytes apart (they are nearly all zero)."""
    width = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width), np.int32)
        for batch in batches:
            for part in byte_slices(batch, "text", PART_BYTES):
                labels = part.column("label").to_pylist()
                for y, f in zip(labels, features(part.column("text").to_pylist(), bits), strict=True):
                    sums[y, f] += 1
        for block in range(0, width, BLOCK):
            own = sums[:, block:block + BLOCK]
            if own.any():
                planes = np.ascontiguousarray(own).view(np.uint8).reshape(-1, 4).T.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block // BLOCK], pa.int32()), pa.array([planes], pa.binary())],
                                                 names=["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, planes in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                own = np.frombuffer(planes, np.uint8).reshape(4, -1).T
                own = np.ascontiguousarray(own).view(np.int32).reshape(2, -1)
                sums[block] = sums.get(block, 0) + own.astype(np.int64)
        for block, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["block", "sums"])

    parts = min(shuffle_partitions(training.sparkSession), width // BLOCK)
    summed = (training.mapInArrow(frugal(count), "block int, sums binary").repartitionById(parts, F.col("block"))
              .mapInArrow(frugal(add), "block int, sums binary"))
    out = np.zeros((2, width))
    for r in summed.toLocalIterator():  # 16 bytes a feature in all
        out[:, r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.sums, np.int64).reshape(2, -1)
    return out[1], out[0]


class Sample:
    """The fit's rows, dealt to folds as they come, each class over all folds."""

    def __init__(self) -> None:
        self.folds = [Blocks() for _ in range(FOLDS)]
        self.y, self.copies, self.weight = ([[] for _ in range(FOLDS)] for _ in range(3))
        self.seen = [0, 0]

    def add(self, row: np.ndarray, label: int, copies: int, weight: float) -> None:
        k = self.seen[label] % FOLDS
        self.seen[label] += 1
        self.folds[k].add(row)
        for held, value in ((self.y, label), (self.copies, copies), (self.weight, weight)):
            held[k].append(value)

    def close(self) -> None:
        for blocks in self.folds:
            blocks.close()

    def joined(self, values: list[list], folds: list[int]) -> np.ndarray:
        return np.concatenate([np.array(values[k], np.float64) for k in folds])


def fit(sample: Sample, pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> tuple[np.ndarray, float]:
    """Weights per feature and bias, calibrated. The counts are of all training
    rows, the rows a sample of them, in which a row stands for ``copies`` equal
    ones and counts by ``weight``."""
    width, all_folds = len(pos), list(range(FOLDS))

    def learn(folds: list[int], counts: tuple) -> tuple[np.ndarray, float]:
        r, z = ratios(*counts)
        keep = np.flatnonzero(z >= MIN_Z)
        new = np.full(width, -1, np.int32)
        new[keep] = np.arange(len(keep))
        w = np.zeros(width)
        w[keep], b = fit_logistic(Stack([sample.folds[k].only(new) for k in folds]), sample.joined(sample.y, folds), len(keep),
                                  L2, r[keep], sample.joined(sample.weight, folds))
        return w, b

    y, weight = sample.joined(sample.y, all_folds), sample.joined(sample.weight, all_folds)
    if min(y.sum(), len(y) - y.sum()) < 2:  # a fold would lack a class
        r, z = ratios(pos, neg, n_pos, n_neg)
        w = np.where(z >= MIN_Z, r, 0.0)
        margins = Stack(sample.folds).dot(w)
        most = max(1.0, np.abs(margins).max(initial=0.0))
        a, c = calibrate(margins / most, y, weight)
        return a / most * w, c
    margins = []
    for k, held in enumerate(sample.folds):
        n, ones = sample.joined(sample.copies, [k]), sample.joined(sample.copies, [k]) * sample.joined(sample.y, [k])
        w, b = learn([j for j in all_folds if j != k], (
            pos - held.back(ones, width), neg - held.back(n - ones, width), n_pos - ones.sum(), n_neg - (n - ones).sum()))
        margins.append(held.dot(w) + b)
    a, c = calibrate(np.concatenate(margins), y, weight)
    w, b = learn(all_folds, (pos, neg, n_pos, n_neg))
    return a * w, a * b + c


def train(training: DataFrame, bits: int = BITS, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """``training``: key, text, label (0 or 1)."""
    n, ones = training.agg(F.count("*"), F.sum("label")).first()
    if not ones or ones == n:
        return np.zeros(1 << bits), float(np.log(((ones or 0) + 0.05) / (n - (ones or 0) + 0.95)))
    pos, neg = class_counts(training, bits)
    # what a fold may still find significant once its own counts are out
    chosen = np.flatnonzero(ratios(pos, neg, ones, n - ones)[1] >= MIN_Z / 2)
    wanted = np.zeros(1 << bits, bool)
    wanted[chosen] = True
    pos, neg = pos[chosen], neg[chosen]

    def fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sample()
        new = np.cumsum(wanted, dtype=np.int32) - 1
        for batch in batches:
            for part in byte_slices(batch, "text", PART_BYTES):
                rows = features(part.column("text").to_pylist(), bits, wanted)
                for row, label, copies in zip(rows, part.column("label").to_pylist(), part.column("copies").to_pylist(), strict=True):
                    sample.add(new[row], label, copies, max(1.0, copies * shares[label]))
        sample.close()
        if sum(sample.seen):
            size = [max(1.0, sum(w for k in range(FOLDS) for w, y in zip(sample.weight[k], sample.y[k], strict=True) if y == label))
                    for label in (0, 1)]
            part_of = [(n - ones) / n, ones / n]
            for k in range(FOLDS):
                sample.weight[k] = [w * part_of[y] / size[y] * sum(sample.seen) for w, y in zip(sample.weight[k], sample.y[k], strict=True)]
            w, b = fit(sample, pos, neg, ones, n - ones)
            yield pa.RecordBatch.from_arrays([pa.array([np.append(w, b).astype(np.float32).tobytes()], pa.binary())], names=["model"])

    buckets = 1 << 30
    shares = [min(1.0, fit_rows / size) for size in (n - ones, ones)]
    order = F.xxhash64(F.lit(17), "key", "text")
    bound = F.when(F.col("label") == 1, F.lit(int(buckets * shares[1]))).otherwise(F.lit(int(buckets * shares[0])))
    sample = (training.withColumn("order", order).filter(F.pmod("order", F.lit(buckets)) < bound)
              .groupBy("order", "label").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
              .repartition(1).sortWithinPartitions("order", "label"))
    model = sample.mapInArrow(frugal(fit_task), "model binary").collect()
    if not model:
        return np.zeros(1 << bits), float(np.log((ones + 0.05) / (n - ones + 0.95)))
    packed = np.frombuffer(model[0].model, np.float32)
    weights = np.zeros(1 << bits, np.float32)
    weights[chosen] = packed[:-1]
    return weights, float(packed[-1])


def score(docs: DataFrame, weights: np.ndarray, bias: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score of every row."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bits = len(weights).bit_length() - 1
    wanted = weights != 0

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", PART_BYTES):
                m = [float(weights[f].sum(dtype=np.float64)) + bias
                     for f in features(part.column("text").to_pylist(), bits, wanted)]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(sigmoid(np.array(m)))], names=["key", "score"])

    return rows.mapInArrow(frugal(scored), f"key {rows.schema['key'].dataType.simpleString()}, score double").withColumnRenamed("key", key)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, chosen: Column, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """key, text, label of the labelled rows of ``docs`` for which ``chosen``
    (over the column ``key``) holds."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & chosen)
    place = F.pmod(F.xxhash64(F.col("key").cast("long")), F.lit(1 << FILTER_BITS))
    marks = (known.select(F.shiftright(place, 6).alias("word"), 
                          F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.stack([batch.column(c).to_numpy() for c in ("word", "bits")])
            yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()], pa.binary())], names=["packed"])

    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in marks.mapInArrow(pack, "packed binary").collect():  # 16 bytes a word of the bitmap at most
        word, bits = np.frombuffer(r.packed, np.int64).reshape(2, -1)
        bitmap[word] = bits
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # 2**(FILTER_BITS - 3) bytes

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            yield batch.filter(pa.array((shared.value[at >> 6] >> (at & 63) & 1).astype(bool))).drop_columns(["place"])

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter(
        chosen & F.col("key").isNotNull())
    kind = rows.schema["key"].dataType.simpleString()
    some = rows.withColumn("place", place).mapInArrow(frugal(maybe), f"key {kind}, text string")
    return some.join(known, "key")


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, folds: int = 4,
             held: int = 2, key: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """key, held_out, score, predicted of every row. Labels of the held-out
    fold (crc32 of the id modulo ``folds`` is ``held``) are never read."""
    training = written(training_rows(docs, labels, label, fold(F.col("key"), folds) != held, key, text), "toxicity-training")
    weights, bias = train(training, fit_rows=fit_rows)
    return score(docs, weights, bias, key, text).select(
        key, (fold(F.col(key), folds) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, folds: int = 4,
               held: int = 2, key: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, with its columns, whose score is below the threshold."""
    training = written(training_rows(docs, labels, label, fold(F.col("key"), folds) != held, key, text), "toxicity-training")
    weights, bias = train(training, fit_rows=fit_rows)
    bits = len(weights).bit_length() - 1
    wanted = weights != 0

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text, PART_BYTES):
                texts = part.column(text).fill_null("").to_pylist()
                m = [float(weights[f].sum(dtype=np.float64)) + bias for f in features(texts, bits, wanted)]
                yield part.filter(pa.array(sigmoid(np.array(m)) < threshold))

    return docs.mapInArrow(frugal(keep), docs.schema)
