"""Quality classifier (operator 2): co-training of a text and a page view.

Two logistic models see different sides of a document:

* text: its case-sensitive character trigrams, hashed, by the root of their
  share of the text;
* page: what is known of the page without reading it, the metadata columns
  (strings one-hot by hash, numbers by the logarithm) and the layout (length,
  lines, words a line, shares of capitals, digits, marks and spaces, share of
  distinct words, of the commonest word).

Each starts from the labelled rows. In every round both views score all
unlabelled documents, and each names its surest ones, a share ``NAMED`` of them in
all, of both classes in the proportion of the labels: the odds are counted in
steps of 1 / ``STEPS``, and the steps that hold that many are the surest. The other
view gets them as pseudo-labels, and both are fitted again. At the end each view is
calibrated on folds of the labelled rows, and the score of a document combines the
calibrated log odds by a logistic model fitted on the same folds. A fold's models
go through the same rounds beside the others, without the fold's labels.

A round is a pass over all documents, which writes their odds, and a fit in one
task. The fit's rows are bounded: about ``label_rows`` labelled ids (of the smallest
hash, one row an id: that of the smallest hash) and, of the surest rows a view names
for a class in a round, about ``draw_rows`` (of the smallest hash, equal rows once).
Long texts are read in pieces, whole.

Null and empty texts have no trigrams and a layout of zeros. Null metadata is a
value of its own. A null label is no label; null ids have none. Without labels of
both classes every score is the smoothed share of label 1. Rows that repeat give
repeated results; an empty table gives none. Columns named like results don't
matter: only id, text and the metadata columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, fold, frugal, is_space, mix64, text_buffers, word_hashes, word_spans, written
from lodestar.llm.linear import Sparse, calibrate, fit_logistic

METADATA = ("lang", "source", "n_chars")
TEXT_BITS, PAGE_BITS = 14, 10
LABEL_ROWS, DRAW_ROWS = 3000, 250
ROUNDS = 2
#: Share of the unlabelled rows that a view names a round.
NAMED = 0.05
STEPS, REACH = 50, 30
FOLDS = 3
L2 = (1e-4, 1e-4)
PART_BYTES = 1 << 20
PIECE = 1 << 21
THRESHOLD = 0.5


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    b = data.astype(np.uint64)
    gram = b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:] if len(b) > 2 else b[:0]
    return (mix64(gram + np.uint64(1)) >> np.uint64(64 - TEXT_BITS)).astype(np.int64)


def text_view(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of feature numbers, and the values of all rows."""
    offsets, data = text_buffers(texts)
    if len(texts) == 1 and len(data) > PIECE:
        counts = np.zeros(1 << TEXT_BITS, np.int64)
        for at in range(0, len(data), PIECE):
            counts += np.bincount(trigram_buckets(data[at:at + PIECE + 2]), minlength=len(counts))
        own = np.flatnonzero(counts)
        return [own], np.sqrt(counts[own] / max(1, counts.sum()))
    bucket = trigram_buckets(data)
    rows, values = [], []
    for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own, n = np.unique(bucket[x:max(x, y - 2)], return_counts=True)
        rows.append(own)
        values.append(np.sqrt(n / max(1, n.sum())))
    return rows, np.concatenate(values) if values else np.zeros(0)


def kinds_of(data: np.ndarray) -> list[np.ndarray]:
    """Which bytes are spaces, line feeds, capitals, digits, marks, beyond ASCII."""
    return [is_space(data), data == 10, (data >= 65) & (data <= 90), (data >= 48) & (data <= 57),
            (data > 32) & (data < 127) & ~((data >= 48) & (data <= 57)) & ~((data | 32) >= 97) | ((data >= 123) & (data < 127)), data >= 128]


def layout_row(n: int, sums: list, words: int, times: np.ndarray) -> list:
    return [1, np.log1p(n) / 12, np.log1p(sums[1]) / 8, np.log1p(words / (1 + sums[1])) / 8,
            *[x / n for x in sums], len(times) / max(1, words), times.max(initial=0) / max(1, words)]


def long_layout(data: np.ndarray) -> list:
    """The layout of one text, from pieces that end before white space."""
    sums, words, at, hashes, times = np.zeros(6, np.int64), 0, 0, [], []
    while at < len(data):
        stop = min(at + PIECE, len(data))
        while stop < len(data):
            space = np.flatnonzero(is_space(data[stop:stop + PIECE]))
            if len(space):
                stop += int(space[0])
                break
            stop = min(stop + PIECE, len(data))
        piece = data[at:stop]
        s, e, _ = word_spans(np.array([0, len(piece)]), piece)
        own, n = np.unique(word_hashes(piece, s, e), return_counts=True)
        sums += [np.count_nonzero(k) for k in kinds_of(piece)]
        words, at = words + len(s), stop
        hashes.append(own)
        times.append(n)
    _, which = np.unique(np.concatenate(hashes), return_inverse=True)
    return layout_row(len(data), sums.tolist(), words, np.bincount(which, np.concatenate(times)))


def layout(texts: pa.Array) -> np.ndarray:
    """A row of layout numbers, all about 0 to 1, per text."""
    offsets, data = text_buffers(texts)
    if len(texts) == 1 and len(data) > PIECE:
        return np.array([long_layout(data)])
    s, e, first = word_spans(offsets, data)
    hashes = word_hashes(data, s, e)
    sums = [np.concatenate([[0], np.cumsum(k)]) for k in kinds_of(data)]
    out = np.zeros((len(texts), 12))
    for i in range(len(texts)):
        x, y, a, b = offsets[i], offsets[i + 1], first[i], first[i + 1]
        if y > x:
            _, times = np.unique(hashes[a:b], return_counts=True)
            out[i] = layout_row(y - x, [c[y] - c[x] for c in sums], b - a, times)
    return out


#: Cuts of the layout numbers: a number becomes the cuts that it has passed.
CUTS = np.concatenate([[1e-9, 0.002, 0.005, 0.01, 0.02, 0.04, 0.06, 0.08], np.arange(0.1, 1.0, 0.05)])


def page_view(texts: pa.Array, metadata: list[list]) -> list[np.ndarray]:
    """Rows of feature numbers: layout steps first, then hashed metadata."""
    numbers = layout(texts)
    width = numbers.shape[1] * len(CUTS)
    rows = []
    for i in range(len(numbers)):
        own = np.flatnonzero((numbers[i][:, None] > CUTS).ravel()).tolist()
        for j, column in enumerate(metadata):
            v = column[i]
            v = f"{np.log2(1 + abs(v)):.0f}" if isinstance(v, int | float) and not isinstance(v, bool) and np.isfinite(v) else str(v)
            own.append(width + (xxhash.xxh64_intdigest(f"{j}:{v}".encode("utf-8", "replace")) >> 64 - PAGE_BITS))
        rows.append(np.unique(np.array(own, np.int64)))
    return rows


WIDTHS = (1 << TEXT_BITS, 12 * len(CUTS) + (1 << PAGE_BITS))


class Views:
    """Both views of the same rows."""

    def __init__(self) -> None:
        self.text: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.page: list[np.ndarray] = []

    def add(self, texts: pa.Array, metadata: list[list]) -> None:
        rows, values = text_view(texts)
        self.text += rows
        self.values += np.split(values, np.cumsum([len(r) for r in rows])[:-1]) if rows else []
        self.page += page_view(texts, metadata)

    def pick(self, which: np.ndarray) -> tuple[Sparse, Sparse]:
        values = [self.values[i] for i in which]
        return (Sparse([self.text[i] for i in which], np.concatenate(values) if values else np.zeros(0)),
                Sparse([self.page[i] for i in which]))


#: For each of the fits (one without each fold, one of all) and each view the
#: pseudo-labels it was given: id of the row -> label.
Given = list[tuple[dict[int, float], dict[int, float]]]
Models = list[list[tuple[np.ndarray, float]]]


def fit_all(views: Views, y: np.ndarray, rid: np.ndarray, given: Given) -> Models:
    """(weights, bias) of both views, for each fit. Rows with a label (y >= 0)
    come first and are dealt to folds in turn; the others are known by their id."""
    labelled = np.flatnonzero(y >= 0)
    out = []
    for k, named in enumerate(given):
        own = labelled[labelled % FOLDS != k]
        models = []
        for v in (0, 1):
            more = [i for i in range(len(labelled), len(y)) if int(rid[i]) in named[v]]
            which = np.concatenate([own, np.array(more, np.int64)])
            labels = np.concatenate([y[own], [named[v][int(rid[i])] for i in more]])
            models.append(fit_logistic(views.pick(which)[v], labels, WIDTHS[v], L2[v]))
        out.append(models)
    return out


def combined(views: Views, y: np.ndarray, models: Models) -> np.ndarray:
    """Calibration of both views and the weights of their log odds, from the
    labelled rows by the models of their folds."""
    labelled = np.flatnonzero(y >= 0)
    held = np.zeros((2, len(labelled)))
    for k in range(FOLDS):
        out = labelled[labelled % FOLDS == k]
        for v, part in enumerate(views.pick(out)):
            held[v, out] = part.dot(models[k][v][0]) + models[k][v][1]
    scales = [calibrate(held[v], y[labelled]) for v in (0, 1)]
    odds = [a * held[v] + b for v, (a, b) in enumerate(scales)]
    both = Sparse([np.array([0, 1])] * len(labelled), np.stack(odds, 1).ravel())
    mix, bias = fit_logistic(both, y[labelled], 2, 1e-3)
    return np.concatenate([*scales, mix, [bias]])


def step_of(odds: str | Column) -> Column:
    return F.floor(F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.col(odds) if isinstance(odds, str) else odds)) * STEPS).cast("int")


def surest(counts: dict[int, int], n: int, sign: int) -> int | None:
    """The last step, from the surest on, that is needed for ``n`` rows on the
    side of ``sign`` (steps of odds over or under 0)."""
    found, last = 0, None
    for step in sorted((s for s in counts if (s >= 0) == (sign > 0)), reverse=sign > 0):
        if found >= n:
            break
        found, last = found + counts[step], step
    return last


def name_surest(odds: DataFrame, shares: list[float], turn: int, draw_rows: int) -> list[tuple[int, int, int, float]]:
    """``odds`` (rid and a column o<fit>_<view> each) of all unlabelled rows ->
    (fit, view that names, rid, label), about ``draw_rows`` a fit, view and class."""
    columns = [(k, v) for k in range(FOLDS + 1) for v in (0, 1)]
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), step_of(f"o{k}_{v}").alias("step")) for i, (k, v) in enumerate(columns)]))
    counts: dict[int, dict[int, int]] = {}
    for r in odds.select(steps.alias("s")).groupBy("s.column", "s.step").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r.column, {})[r.step] = r.n  # 8 * 2 * STEPS * REACH rows at most
    total = sum(counts.get(0, {}).values())
    n, place, picks = max(2, int(NAMED * total)), F.pmod(F.xxhash64(F.lit(turn), "rid"), F.lit(1 << 30)), []
    for i, (k, v) in enumerate(columns):
        ones = max(1, round(n * shares[k]))
        for label, many in ((1, ones), (0, max(1, n - ones))):
            sign = 1 if label else -1
            last = surest(counts.get(i, {}), many, sign)
            if last is None:
                continue
            held = sum(c for s, c in counts[i].items() if (s >= 0) == (sign > 0) and s * sign >= last * sign)
            step = step_of(f"o{k}_{v}")
            sure = (step >= last) if label else (step <= last)
            picks.append(F.when(sure & (place < int((1 << 30) * min(1.0, draw_rows / held))),
                                F.struct(F.lit(k).alias("fit"), F.lit(v).alias("view"), F.lit(label).alias("label"))))
    if not picks:
        return []
    drawn = odds.select("rid", F.explode(F.array_compact(F.array(*picks))).alias("p")).distinct()
    return sorted((r.p.fit, r.p.view, r.rid, float(r.p.label)) for r in drawn.collect())  # about draw_rows a pick


def unpacked(flat: np.ndarray) -> Models:
    out, at = [], 0
    while at < len(flat):
        models = []
        for width in WIDTHS:
            models.append((flat[at:at + width], float(flat[at + width])))
            at += width + 1
        out.append(models)
    return out


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: Sequence[str] = METADATA,
            threshold: float = THRESHOLD, folds: int = 4, held: int = 2, key: str = "doc_id", text: str = "text",
            label_rows: int = LABEL_ROWS, draw_rows: int = DRAW_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """Per row: key, held_out (labels of that fold, crc32 of the id modulo
    ``folds`` is ``held``, are never read), text_score, page_score, score,
    predicted (1 if the score reaches the threshold)."""
    spark = docs.sparkSession
    names = [f"m{i}" for i in range(len(metadata))]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       *[F.col(c).alias(n) for c, n in zip(metadata, names, strict=True)])
    rows = rows.withColumn("rid", F.xxhash64("key", "text", *names))
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & (fold(F.col("key"), folds) != held)).distinct()
    n_known, ones = known.agg(F.count("*"), F.sum("label")).first()
    ones = ones or 0

    def views_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, Views]]:
        for batch in batches:
            for part in byte_slices(batch, column, PART_BYTES, 1 << 12):
                views = Views()
                views.add(part.column(column), [part.column(n).to_pylist() for n in names])
                yield part, views

    def odds_by(models: Models, kind: str) -> DataFrame:
        """key, rid, o<fit>_<view>: log odds of every row by every model."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, views in views_of(batches, "text"):
                both = views.pick(np.arange(len(part)))
                found = [pa.array(both[v].dot(w) + b) for fit in models for v, (w, b) in enumerate(fit)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("rid"), *found], names=columns)

        columns = ["key", "rid", *[f"o{k}_{v}" for k in range(len(models)) for v in (0, 1)]]
        return rows.mapInArrow(frugal(run), f"key {kind}, rid long, " + ", ".join(f"{c} double" for c in columns[2:]))

    def fitted(sample: DataFrame, given: Given, last: bool) -> tuple[Models, np.ndarray] | None:
        """From ``sample`` (rid, label, text, metadata), in one task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            views, y, rid = Views(), [], []
            for part, some in views_of(batches, "text"):
                views.text += some.text
                views.values += some.values
                views.page += some.page
                y += part.column("label").to_pylist()
                rid += part.column("rid").to_pylist()
            y, rid = np.array(y, np.float64), np.array(rid, np.int64)
            sure = y[y >= 0]
            of_fold = [sure[np.arange(len(sure)) % FOLDS != k] for k in range(FOLDS + 1)]
            if all(0 < f.sum() < len(f) for f in of_fold):
                models = fit_all(views, y, rid, given)
                flat = np.concatenate([np.append(w, b) for fit in models for w, b in fit])
                extra = np.append(combined(views, y, models) if last else np.zeros(7), [f.mean() for f in of_fold])
                yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary()), pa.array([extra.tobytes()], pa.binary())],
                                                 names=["models", "extra"])

        ordered = sample.repartition(1).sortWithinPartitions((F.col("label") < 0).asc(), "place", "label", "rid")
        got = ordered.mapInArrow(frugal(run), "models binary, extra binary").collect()  # vectors of fixed length
        return (unpacked(np.frombuffer(got[0].models)), np.frombuffer(got[0].extra)) if got else None

    result = None
    kind = rows.schema["key"].dataType.simpleString()
    if 0 < ones < n_known:
        place = F.pmod(F.xxhash64(F.lit(29), "key"), F.lit(1 << 30))
        some = known.withColumn("place", place).filter(F.col("place") < int((1 << 30) * min(1.0, label_rows / n_known)) + 1)
        row = F.struct("rid", "text", *names)
        sample = written(rows.join(some, "key").groupBy("key", "place", "label").agg(F.min_by(row, "rid").alias("row"))
                         .select("place", "label", "row.*"), "co-labelled")
        given: Given = [({}, {}) for _ in range(FOLDS + 1)]
        for turn in range(rounds + 1):
            result = fitted(sample, given, turn == rounds)
            if result is None or turn == rounds:
                break
            odds = written(odds_by(result[0], kind), "co-odds")
            free = odds.join(known.select("key").distinct(), "key", "left_anti")
            fresh = set()
            for k, v, rid, y in name_surest(free, result[1][7:].tolist(), turn, draw_rows):
                if given[k][1 - v].setdefault(rid, y) == y:
                    fresh.add(rid)
            if fresh:
                ids = F.broadcast(spark.createDataFrame([(r,) for r in sorted(fresh)], "rid long"))  # 16 * draw_rows or so
                texts = rows.join(ids, "rid", "left_semi").groupBy("rid").agg(F.first(F.struct("text", *names)).alias("row"))
                more = texts.select(F.lit(0).cast("long").alias("place"), F.lit(-1).alias("label"), "rid", "row.*")
                sample = written(sample.unionByName(more).dropDuplicates(["rid", "label"]), "co-sample")
    if result is None:
        share = (ones + 0.5) / (n_known + 1)
        even = np.log(share / (1 - share))
        models, extra = [[(np.zeros(w), 0.0) for w in WIDTHS]], np.array([1, even, 1, even, 0.5, 0.5, 0])
    else:
        models, extra = result[0][FOLDS:], result[1][:7]
    scale, (m0, m1, bias) = extra[:4].reshape(2, 2), extra[4:].tolist()
    text_odds, page_odds = ((F.col(f"o0_{v}") * float(scale[v][0]) + float(scale[v][1])) for v in (0, 1))
    chance = lambda x: (F.tanh(x * 0.5) + 1.0) * 0.5
    return odds_by(models, kind).select(
        F.col("key").alias(key), (fold(F.col("key"), folds) == held).alias("held_out"), chance(text_odds).alias("text_score"),
        chance(page_odds).alias("page_score"), chance(text_odds * m0 + page_odds * m1 + bias).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
