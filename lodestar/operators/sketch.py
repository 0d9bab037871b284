"""Count-min sketch over a column of integer ids.

The sketch is an ordinary aggregate table ``(h, bucket, n)``: every event
is exploded into its ``len(params)`` cells (narrow), and the cells are
counted with partial aggregation, so a hot id that is a third of the
stream costs one row per partition in the shuffle.  Its size is bounded by
``len(params) * n_buckets`` whatever the stream length, which is the proven
bound under which probing broadcasts it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.hashing import CMS_BUCKETS, CMS_PARAMS, CMS_PRIME, linear_hash


def cms_cells(df: DataFrame, col: str | Column, n_buckets: int = CMS_BUCKETS,
              params: Sequence[tuple[int, int]] = CMS_PARAMS, p: int = CMS_PRIME,
              keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, h, bucket)``: the cells of each row's id, one row per hash."""
    x = F.col(col) if isinstance(col, str) else col
    cells = F.array(*[F.struct(F.lit(h).alias("h"), linear_hash(x, a, b, p, n_buckets).alias("bucket"))
                      for h, (a, b) in enumerate(params)])
    return df.select(*keep, F.inline(cells))


def cms_sketch(df: DataFrame, col: str | Column, n_buckets: int = CMS_BUCKETS,
               params: Sequence[tuple[int, int]] = CMS_PARAMS, p: int = CMS_PRIME) -> DataFrame:
    """``(h, bucket, n)``; cells never hit are absent (count 0)."""
    return (cms_cells(df, col, n_buckets, params, p)
            .groupBy("h", "bucket").agg(F.count(F.lit(1)).alias("n")))


def cms_total(sketch: DataFrame) -> DataFrame:
    """Events seen so far, as the total of hash row 0."""
    return sketch.filter(F.col("h") == 0).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"))


def cms_estimate(sketch: DataFrame, probes: DataFrame, col: str = "id",
                 n_buckets: int = CMS_BUCKETS, params: Sequence[tuple[int, int]] = CMS_PARAMS,
                 p: int = CMS_PRIME) -> DataFrame:
    """``(id, estimate)`` = min over hash rows of the cell
    counts; a missing cell counts 0, so an id never seen estimates 0."""
    cells = cms_cells(probes.select(F.col(col).alias("id")).distinct(), "id", n_buckets, params,
                      p, keep=["id"])
    small = F.broadcast(sketch.select("h", "bucket", "n"))   # <= len(params) * n_buckets rows
    return (cells.join(small, ["h", "bucket"], "left")
            .groupBy("id").agg(F.min(F.coalesce("n", F.lit(0))).alias("estimate")))


def cms_error(df: DataFrame, col: str, n_buckets: int = CMS_BUCKETS,
              params: Sequence[tuple[int, int]] = CMS_PARAMS, p: int = CMS_PRIME) -> DataFrame:
    """``(id, true_n, estimate, norm_freq, rel_error)`` for every
    distinct id: ``norm_freq = true_n / t`` and
    ``rel_error = (estimate - true_n) / true_n`` (F18)."""
    # one scan: the sketch and the total follow from the true counts
    truth = (df.groupBy(F.col(col).alias("id")).agg(F.count(F.lit(1)).alias("true_n"))
             .persist(StorageLevel.MEMORY_AND_DISK))
    sketch = (cms_cells(truth, "id", n_buckets, params, p, keep=["true_n"])
              .groupBy("h", "bucket").agg(F.sum("true_n").alias("n")))
    total = truth.agg(F.sum("true_n")).first()[0] or 0
    est = cms_estimate(sketch, truth, "id", n_buckets, params, p)
    return (truth.join(est, "id")
            .select("id", "true_n", "estimate",
                    (F.col("true_n") / F.lit(total)).alias("norm_freq"),
                    ((F.col("estimate") - F.col("true_n")) / F.col("true_n")).alias("rel_error")))
