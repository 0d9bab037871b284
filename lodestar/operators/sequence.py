"""Operators over one global order without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one
task.  These helpers range-partition on the order key instead (balanced by
Spark's sampling; with a unique key even a hot value is split), apply the
window inside each range partition, and stitch partition boundaries with a
summary that has one row per partition -- its size is bounded by the
partition count, never by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _n_parts(df: DataFrame, n_parts: int | None) -> int:
    if n_parts:
        return n_parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, order: Sequence[str], n_parts: int | None) -> DataFrame:
    return (df.repartitionByRange(_n_parts(df, n_parts), *order)
            .withColumn("_pid", F.spark_partition_id()))


def with_global_index(df: DataFrame, order: Sequence[str], out: str = "idx",
                      n_parts: int | None = None) -> DataFrame:
    """Add a 0-based position in the total order ``order`` (a unique key).

    Distributed ``zipWithIndex``: local row numbers plus a per-partition
    offset (running count over at most ``n_parts`` summary rows).  The rows
    move once, into their ranges; a sorted range numbers its rows by the
    position that ``monotonically_increasing_id`` holds in its low 33 bits.

    Range partitioning samples its bounds with a seed tied to the RDD, so
    two separately planned passes may cut the data differently.  The ranged,
    locally numbered rows are therefore cached once and both the summary
    and the rows are read from that cache (a lost cache partition is
    recomputed through the same shuffle dependency, hence the same bounds).
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    local = (df.repartitionByRange(_n_parts(df, n_parts), *order).sortWithinPartitions(*order)
             .withColumns({"_pid": F.spark_partition_id(), "_lrn": position})
             .persist(StorageLevel.MEMORY_AND_DISK))
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_pid", "_lrn", "_off"))


def with_global_next(df: DataFrame, order: Sequence[str], cols: Sequence[str],
                     prefix: str = "next_", n_parts: int | None = None) -> DataFrame:
    """``lead(c) over (order by order)`` for each c, without one-task windows.

    Rows get ``next_<c>`` = value of c in the following row of the global
    order (null after the last row).
    """
    w = Window.partitionBy("_pid").orderBy(*order)
    # cached once: the boundary summary and the rows must see the same cut
    local = _ranged(df, order, n_parts).select(
        "*",
        *[F.lead(c).over(w).alias(f"_lead_{c}") for c in cols],
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
        F.row_number().over(w).alias("_rn")).persist(StorageLevel.MEMORY_AND_DISK)
    firsts = local.filter(F.col("_rn") == 1).select("_pid", *[F.col(c).alias(f"_first_{c}")
                                                            for c in cols])
    by_pid = Window.orderBy("_pid")
    boundary = firsts.select("_pid", *[F.lead(f"_first_{c}").over(by_pid).alias(f"_bnd_{c}")
                                       for c in cols])
    out = local.join(F.broadcast(boundary), "_pid", "left")
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.when(F.col("_last"), F.col(f"_bnd_{c}"))
                             .otherwise(F.col(f"_lead_{c}")))
    return out.drop("_pid", "_last", "_rn", *[f"_lead_{c}" for c in cols],
                    *[f"_bnd_{c}" for c in cols])
