"""Linear SVM by full-batch and mini-batch sub-gradient descent.

The rows are packed once into cached blocks (matrices of up to ``BLOCK_ROWS``
rows); a job over them multiplies whole blocks and returns a vector of sums per
task, added in task order on the driver. The driver never sees the table's rows
but those of the next mini-batches.

* Full batch: a job a round. It gives, at once, the hinge cost of the current
  model on all rows (A17, N15) and the sub-gradient over the margin violators
  (A18, P11).
* Mini-batch: an update needs the rows of its batch alone, so the driver reads
  those of the next ``SEGMENT`` rounds (``SEGMENT * batch_size`` rows), makes the
  updates, and one job gives the costs of all these models on all rows. The stop
  rule is then applied to them in turn. Thousands of rounds take dozens of jobs.

Rows whose label or features are null, or whose features hold a null, take no
part. Empty tables give the zero model and a history of one round of cost 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.vectors import dot_const
from lodestar.operators.sequence import with_global_index
from lodestar.operators.vector_sums import vector_sums
from lodestar.plans.restart import last_state, write_state

BLOCK_ROWS = 4096
#: Rounds between two written states, and mini-batch rounds a job.
SEGMENT = 250


def svm_rows(df: DataFrame, label: str = "label", features: str = "features",
             id_col: str = "vec_id", positive_below: int = 5) -> DataFrame:
    """``(row_id, features, y)`` with y = +1 when ``label < positive_below``."""
    return df.select(F.col(id_col).alias("row_id"), F.col(features).alias("features"),
                     F.when(F.col(label) < positive_below, 1).otherwise(-1).alias("y"))


def _margin(w: Sequence[float], b: float) -> Column:
    """``y * (x . w + b)``; the dot product is unrolled column arithmetic
    (compiled by whole-stage codegen) for models up to ``UNROLL_MAX``."""
    return F.col("y") * (dot_const("features", w) + F.lit(float(b)))


def _round(rows: DataFrame, w: Sequence[float], b: float, c: float,
           in_batch: Column | None = None):
    """Cost of (w, b) on all rows and the gradient on ``in_batch`` rows."""
    dim = len(w)
    rows = rows.withColumn("_m", _margin(w, b))         # computed once per row
    m = F.col("_m")
    viol = m < 1
    if in_batch is not None:
        viol = viol & in_batch
    neg_y = F.when(viol, -F.col("y").cast("double")).otherwise(F.lit(0.0))
    sums, extras = vector_sums(
        rows, "features", dim, (), weight=neg_y,
        extra=[F.sum(F.greatest(F.lit(0.0), F.lit(1.0) - m)).alias("hinge"),
               F.sum(neg_y).alias("gb")])
    g, r = sums.get((), [0.0] * dim), extras.get((), {})
    hinge = r.get("hinge") or 0.0
    cost = 0.5 * sum(x * x for x in w) + c * hinge
    dw = [w[d] + c * g[d] for d in range(dim)]
    db = c * (r.get("gb") or 0.0)
    return cost, dw, db


def svm_cost_gradient(rows: DataFrame, w: Sequence[float], b: float, c: float = 100.0):
    """A17 + A18 for a fixed model: ``(cost, dW, db)``."""
    return _round(rows, w, b, c)


def pct_change(prev: float, cur: float) -> float:
    """``|prev - cur| * 100 / prev``."""
    return abs(prev - cur) * 100.0 / prev


def _usable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("y").isNotNull() & F.col("features").isNotNull() & ~F.exists("features", F.isnull))


def _smoothed(before: float | None, prev: float, cur: float) -> float:
    """Half the last value (0 at first), half the percent change."""
    return 0.5 * (before or 0.0) + 0.5 * pct_change(prev, cur)


def _blocks(rows: DataFrame, dim: int) -> DataFrame:
    """``rows`` (features, y) as matrices: n, x (n * dim doubles), y (n doubles)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column("features").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                y = part.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
                assert len(x) == len(y) * dim, "features of another length"
                yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), pa.array([x.tobytes()], pa.binary()),
                                                  pa.array([y.tobytes()], pa.binary())], names=["n", "x", "y"])

    return rows.select("features", "y").mapInArrow(pack, "n int, x binary, y binary")


def _block_sums(blocks: DataFrame, dim: int, width: int, sums: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``sums`` (x, y) -> vector of ``width``, added up over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                y = np.frombuffer(y.as_buffer(), np.float64)
                total += sums(np.frombuffer(x.as_buffer(), np.float64).reshape(len(y), dim), y)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    total = np.zeros(width)
    for r in blocks.mapInArrow(run, "sums binary").collect():  # a vector a task, in task order
        total += np.frombuffer(r.sums, np.float64)
    return total


def _ended(cost: float, change: float | None, stop: float) -> bool:
    return cost == 0.0 or (change is not None and change <= stop)


def svm_batch_fit(rows: DataFrame, dim: int, c: float = 100.0, lr: float = 3e-7, stop: float = 0.25,
                  max_rounds: int = 2000, state_dir: str | None = None):
    """Batch gradient from W = 0, b = 0; stop when the percent change
    of the cost is <= ``stop`` or after ``max_rounds`` rounds.  Both deltas
    use the pre-step model (N14).  Returns ``(w, b, history)`` with
    ``history = [(iteration, cost, pct_change or None)]``.  With ``state_dir``
    (a shared folder) a new run goes on from the last state written."""
    spark = rows.sparkSession
    state, hist = (state_dir and last_state(spark, state_dir)) or ({"w": [0.0] * dim, "b": 0.0}, [])
    w, b, change = np.array(state["w"]), state["b"], hist[-1][2] if hist else None
    blocks = _blocks(_usable(rows), dim).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while len(hist) < max_rounds and not (hist and _ended(hist[-1][1], change, stop)):

            def round_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray = w, b: float = b) -> np.ndarray:
                m = y * (x @ w + b)
                viol = np.where(m < 1, -y, 0.0)
                return np.concatenate([viol @ x, [viol.sum(), np.maximum(0.0, 1.0 - m).sum()]])

            sums = _block_sums(blocks, dim, dim + 2, round_sums)
            cost = float(0.5 * (w @ w) + c * sums[dim + 1])
            change = pct_change(hist[-1][1], cost) if hist else None
            w, b = w - lr * (w + c * sums[:dim]), float(b - lr * (c * sums[dim]))
            hist.append((len(hist), cost, change))
            if state_dir and len(hist) % SEGMENT == 0:
                write_state(spark, state_dir, {"w": w.tolist(), "b": b}, hist)
    finally:
        blocks.unpersist()
    return w.tolist(), b, hist


def minibatch_order(rows: DataFrame, batch_size: int, id_col: str = "row_id") -> DataFrame:
    """A fixed pseudo-random permutation (``pmod(id * 48271, 2^31-1)``,
    ties by id) cut into batches of ``batch_size``; adds ``batch``.

    The position comes from a distributed row index (range partitions plus
    per-partition offsets), not from a single-task window.
    """
    keyed = rows.withColumn("_perm", F.pmod(F.col(id_col) * F.lit(48271), F.lit(2147483647)))
    idx = with_global_index(keyed, ["_perm", id_col], out="_pos")
    return idx.withColumn("batch", F.floor(F.col("_pos") / batch_size).cast("long")).drop(
        "_perm", "_pos")


def svm_minibatch_fit(rows: DataFrame, dim: int, c: float = 100.0, lr: float = 1e-5, batch_size: int = 20,
                      stop: float = 0.01, max_rounds: int = 6000, state_dir: str | None = None):
    """Round k uses batch ``k mod ceil(n / batch_size)`` (N13); cost on
    all rows; stop on the smoothed change ``0.5 prev + 0.5 pct`` (W4, from
    0).  Returns ``(w, b, history)`` with ``(iteration, cost, smoothed)``.
    A batch size of 1 is stochastic descent, a row a round.  ``state_dir`` as
    for the batch fit."""
    spark = rows.sparkSession
    state, hist = (state_dir and last_state(spark, state_dir)) or ({"w": [0.0] * dim, "b": 0.0}, [])
    w, b, change = np.array(state["w"]), state["b"], hist[-1][2] if hist else None
    data = minibatch_order(_usable(rows), batch_size).select("row_id", "features", "y", "batch").persist(StorageLevel.MEMORY_AND_DISK)
    blocks = _blocks(data, dim).persist(StorageLevel.MEMORY_AND_DISK)
    n_batches, known = max(1, -(-data.count() // batch_size)), {}
    try:
        while len(hist) < max_rounds and not (hist and _ended(hist[-1][1], change, stop)):
            todo = range(len(hist), min(len(hist) + SEGMENT, max_rounds))
            wanted = {k % n_batches for k in todo}
            if not wanted <= known.keys():
                known = {k: ([], []) for k in wanted}
                for r in data.filter(F.col("batch").isin(sorted(wanted))).orderBy("batch", "row_id").collect():  # SEGMENT batches
                    known[r.batch][0].append(r.features)
                    known[r.batch][1].append(r.y)
            models = []
            for k in todo:
                models.append((w, b))
                x, y = np.array(known[k % n_batches][0], np.float64).reshape(-1, dim), np.array(known[k % n_batches][1], np.float64)
                viol = np.where(y * (x @ w + b) < 1, -y, 0.0)
                w, b = w - lr * (w + c * (viol @ x)), float(b - lr * (c * viol.sum()))
            all_w, all_b = np.stack([m[0] for m in models]), np.array([m[1] for m in models])

            def hinges(x: np.ndarray, y: np.ndarray, all_w: np.ndarray = all_w, all_b: np.ndarray = all_b) -> np.ndarray:
                return np.maximum(0.0, 1.0 - y[:, None] * (x @ all_w.T + all_b)).sum(axis=0)

            costs = 0.5 * (all_w * all_w).sum(axis=1) + c * _block_sums(blocks, dim, len(models), hinges)
            for i, cost in enumerate(costs.tolist()):
                change = _smoothed(change, hist[-1][1], cost) if hist else None
                hist.append((len(hist), cost, change))
                if _ended(cost, change, stop):
                    w, b = models[i + 1] if i + 1 < len(models) else (w, b)
                    break
            if state_dir:
                write_state(spark, state_dir, {"w": w.tolist(), "b": b}, hist)
    finally:
        data.unpersist()
        blocks.unpersist()
    return w.tolist(), b, hist


def history_frame(spark: SparkSession, hist, third: str, digits: int = 3,
                  third_digits: int = 6) -> DataFrame:
    """``(iteration, cost, <third>)`` rows of a fit."""
    df = spark.createDataFrame([(int(k), float(cst), None if x is None else float(x))
                                for k, cst, x in hist],
                               f"iteration int, cost double, {third} double")
    return df.select("iteration", F.round("cost", digits).alias("cost"),
                     F.round(third, third_digits).alias(third))


def model_frame(spark: SparkSession, w: Sequence[float], b: float, digits: int = 6) -> DataFrame:
    """The learned model: ``(dim, value)``, W by dimension and b as dimension -1."""
    rows = [(d, float(x)) for d, x in enumerate(w)] + [(-1, float(b))]
    return spark.createDataFrame(rows, "dim int, value double").select("dim", F.round("value", digits).alias("value"))
