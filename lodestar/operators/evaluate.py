"""Evaluation curves over per-iteration histories.

A history has one row per round, so its size is bounded by the round
count; the windows below order it by ``iteration``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def percent_changes(hist: DataFrame, cost: str = "cost", it: str = "iteration") -> DataFrame:
    """``pct_change = |prev - cur| * 100 / prev`` (null on the first row)."""
    prev = F.lag(cost).over(Window.orderBy(it))
    return hist.withColumn("pct_change", F.abs(prev - F.col(cost)) * 100.0 / prev)


def smoothed_changes(hist: DataFrame, cost: str = "cost", it: str = "iteration") -> DataFrame:
    """``s_k = 0.5 s_{k-1} + 0.5 pct_k`` from ``s = 0`` (null on row 0)."""
    w = Window.orderBy(it).rowsBetween(Window.unboundedPreceding, 0)
    pct = percent_changes(hist, cost, it)
    return pct.withColumn(
        "smoothed",
        F.when(F.col("pct_change").isNull(), F.lit(None).cast("double")).otherwise(
            F.aggregate(F.collect_list("pct_change").over(w), F.lit(0.0),
                        lambda s, d: F.lit(0.5) * s + F.lit(0.5) * d)))
