"""k-means with given initial centroids (M7): L2-squared or L1 assignment,
mean update, loss per round measured with the centroids before the update.

The centroids are model state of k x dim numbers handed to every task (the
map-side hash table of the reference).  Distances are computed per Arrow
batch with vectorised numpy inside ``mapInPandas`` -- Spark's higher-order
array functions would be interpreted row by row, and k x dim unrolled
column terms overflow generated-code method limits.  Each round is a
single job: every task folds its points into k partial rows (count, loss,
per-dimension sums) and Spark sums the partials by cluster, so only
k x dim numbers per partition cross the network, however large one
cluster is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.vectors import distance as distance_fn
from lodestar.sources.sinks import write_iterations
from lodestar.operators.vector_sums import vector_sums

FLOAT_MAX = 3.4028234663852886e38


# Rows per block of the distance computation (block x centroids x dim
# doubles are materialised at once).
_BLOCK_ELEMENTS = 4_000_000


def _nearest_block(x: np.ndarray, centers: np.ndarray, distance: str):
    """Nearest centroid of each row of ``x``: ``(cluster, dist, valid)``.

    W5: ``argmin`` returns the first minimum, so the lowest index wins
    ties; P8: NaN or >= Float.MAX distances are not candidates.
    """
    k, dim = centers.shape
    d = np.empty((x.shape[0], k))
    step = max(1, _BLOCK_ELEMENTS // max(1, x.shape[0] * dim))
    for j in range(0, k, step):
        diff = x[:, None, :] - centers[None, j:j + step, :]
        d[:, j:j + step] = (diff * diff if distance == "l2" else np.abs(diff)).sum(axis=2)
    d[~(d < FLOAT_MAX)] = np.inf                    # NaN and overflow are never nearest
    cluster = d.argmin(axis=1)
    dist = d[np.arange(d.shape[0]), cluster]
    return cluster, dist, np.isfinite(dist)


def _matrix(series: pd.Series, dim: int) -> np.ndarray:
    if len(series) == 0:
        return np.empty((0, dim))
    return np.stack(series.to_numpy()).astype(np.float64, copy=False)


def kmeans_assign(points: DataFrame, centers: Sequence[Sequence[float]], distance: str = "l2",
                  features: str = "features", id_col: str = "vec_id") -> DataFrame:
    """``(id, cluster, dist)`` for every point with a finite distance.

    The k x dim centroids travel with the task; each Arrow batch of points
    is scored with vectorised numpy (no per-row Python, no cross join).
    """
    distance_fn(distance)                                    # validates the name (X8)
    cent = np.asarray(centers, dtype=np.float64)
    id_type = points.schema[id_col].dataType.simpleString()

    def score(batches):
        for pdf in batches:
            x = _matrix(pdf[features], cent.shape[1])
            cluster, dist, ok = _nearest_block(x, cent, distance.lower())
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy()[ok],
                                "cluster": cluster[ok].astype(np.int32), "dist": dist[ok]})

    return points.select(id_col, features).mapInPandas(
        score, f"{id_col} {id_type}, cluster int, dist double")


def _round_stats(points: DataFrame, centers, distance: str, features: str, dim: int):
    """Per cluster ``(n, loss, sums)``: each task folds its points into k
    partial rows (map-side combine in numpy); Spark sums the partials."""
    cent = np.asarray(centers, dtype=np.float64)
    k = cent.shape[0]

    def fold(batches):
        n, loss, sums = np.zeros(k, np.int64), np.zeros(k), np.zeros((k, dim))
        for pdf in batches:
            x = _matrix(pdf[features], dim)
            cluster, dist, ok = _nearest_block(x, cent, distance)
            cluster, dist, x = cluster[ok], dist[ok], x[ok]
            n += np.bincount(cluster, minlength=k)
            loss += np.bincount(cluster, weights=dist, minlength=k)
            np.add.at(sums, cluster, x)
        hit = np.nonzero(n)[0]
        if len(hit):
            yield pd.DataFrame({"cluster": hit.astype(np.int32), "n": n[hit], "loss": loss[hit],
                                "sums": list(sums[hit])})

    partials = points.select(features).mapInPandas(
        fold, "cluster int, n long, loss double, sums array<double>")
    sums, extras = vector_sums(partials, "sums", dim, ["cluster"],
                               extra=[F.sum("n").alias("n"), F.sum("loss").alias("loss")])
    return {key[0]: (extras[key]["n"], extras[key]["loss"], sums[key]) for key in extras}


def kmeans_step(points: DataFrame, centers: Sequence[Sequence[float]], distance: str = "l2",
                features: str = "features", drop_empty: bool = False):
    """One round (A8, A9).  Returns ``(new_centers, loss)``.

    An empty cluster keeps its centroid under its id (default) or is
    removed with later ids shifting down (``drop_empty``, N4).
    """
    dim = len(centers[0])
    distance_fn(distance)
    stats = _round_stats(points, centers, distance.lower(), features, dim)
    loss = float(sum(s[1] for s in stats.values()))
    new = []
    for k, c in enumerate(centers):
        if k not in stats:
            if not drop_empty:
                new.append(list(c))
            continue
        n, _, sums = stats[k]
        new.append([x / n for x in sums])
    return new, loss


def kmeans_fit(points: DataFrame, centers: Sequence[Sequence[float]], rounds: int = 21,
               distance: str = "l2", features: str = "features", drop_empty: bool = False,
               iteration_dir: str | None = None):
    """M7: ``rounds`` rounds (the reference's 0..20 inclusive is 21).

    Returns ``(centers, losses)``; the points are cached once (I5).  With
    ``iteration_dir`` every round's centroids and loss are also written
    there, one ``iteration=<i>`` folder per round (K3).
    """
    spark = points.sparkSession
    pts = points.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    losses = []
    try:
        for i in range(rounds):
            centers, loss = kmeans_step(pts, centers, distance, features, drop_empty)
            losses.append(loss)
            if iteration_dir:
                write_iterations(centers_frame(spark, centers).select(
                    F.lit(i).alias("iteration"), "cluster", "center", F.lit(loss).alias("loss")),
                    iteration_dir)
    finally:
        pts.unpersist()
    return centers, losses


def loss_frame(spark: SparkSession, losses: Sequence[float], digits: int = 6) -> DataFrame:
    """``(iteration, loss)`` rows of a fitted run."""
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(losses)],
                                 "iteration int, loss double").select(
        "iteration", F.round("loss", digits).alias("loss"))


def centers_frame(spark: SparkSession, centers: Sequence[Sequence[float]]) -> DataFrame:
    """``(cluster, center)`` rows; F10 text form via ``array_join``."""
    return spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centers)],
                                 "cluster int, center array<double>")


def initial_centers(df: DataFrame, ids: Sequence[int], id_col: str = "vec_id",
                    features: str = "features") -> list[list[float]]:
    """Read k starting centroids (S13) by id; k is a parameter, not data size.
    An id without a row is an error, as it would shift all cluster numbers."""
    rows = df.filter(F.col(id_col).isin(list(ids))).select(id_col, features).collect()
    by_id = {r[0]: list(r[1]) for r in rows}
    if missing := [i for i in ids if i not in by_id]:
        raise ValueError(f"no rows for the starting centroids {missing}")
    return [by_id[i] for i in ids]
