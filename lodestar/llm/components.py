"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges: a vertex points its larger neighbours, then its
smaller ones, at its least neighbour. The table never grows beyond its edges,
ends as one star per component around the least vertex, and takes a number of
rounds that grows with the logarithm of the longest chain. Nothing is
collected; a round ends in a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge runs from its larger vertex u to its smaller vertex v
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``edges`` (two long columns) -> (vertex, root): the least vertex of each
    vertex's component, for vertices that have an edge to another one. Nulls
    and self loops are left out."""
    pairs = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = written(pairs.distinct(), "stars")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "stars")
        before, state = state, _state(now)
        if state == before:
            break
    stars = now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("vertex"), "root").distinct())
