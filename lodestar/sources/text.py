"""Line-oriented readers for the reference's text layouts.

All parsing is built-in column expressions over ``spark.read.text`` or the
CSV reader with an explicit schema (never inferred).  Casts follow ANSI
mode: malformed numbers raise inside the task (F5); ``permissive=True``
readers use ``try_cast`` and yield nulls instead.

Where a layout is positional (line *i* is item *i*), ``read_lines_indexed``
recovers the line number without a single-partition step: the order of a
line is ``(file, split start, position within split)``, all known to the
scan, and the global index comes from a distributed row index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import java_split, python_split, rtrim_ws
from lodestar.operators.sequence import with_global_index


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (any Hadoop path)."""
    return spark.read.text(path)


def read_lines_indexed(spark: SparkSession, path: str, out: str = "idx") -> DataFrame:
    """``(idx, value)``: the 0-based line number across the files of
    ``path`` in file-name order (part files of an ordered write)."""
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_s"),
        F.monotonically_increasing_id().alias("_m"))
    return with_global_index(raw, ["_f", "_s", "_m"], out=out).select(out, "value")


def _cast(col, to: str, permissive: bool):
    return col.try_cast(to) if permissive else col.cast(to)


def read_adjacency(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """S3: ``user<TAB>f1,f2,...`` -> ``(user long, friends array<long>)``;
    a line without a tab is a user without friends (empty array)."""
    parts = F.split(F.col("value"), "\t")
    friends = F.when(F.size(parts) < 2, F.array().cast("array<string>")).otherwise(
        F.split(F.get(parts, 1), ","))
    return spark.read.text(path).select(
        _cast(F.get(parts, 0), "long", permissive).alias("user"),
        F.transform(friends, lambda x: _cast(x, "long", permissive)).alias("friends"))


def adjacency_edges(adj: DataFrame) -> DataFrame:
    """Long form ``(src, dst, pos)`` of adjacency rows (``pos`` = list order)."""
    return adj.select(F.col("user").alias("src"), F.posexplode("friends").alias("pos", "dst"))


def read_edges_tab(spark: SparkSession, path: str) -> DataFrame:
    """``src<TAB>dst`` integer edges."""
    return spark.read.csv(path, sep="\t", schema="src long, dst long", mode="FAILFAST")


def read_edges_ws(spark: SparkSession, path: str) -> DataFrame:
    """First two whitespace tokens as string page ids (F3); other
    tokens are ignored. Lines of fewer tokens are left out;
    ``operators.text.short_records(..., tokens=2)`` counts them."""
    toks = python_split("value")
    return (spark.read.text(path).select(toks.alias("t")).filter(F.size("t") >= 2)
            .select(F.get("t", 0).alias("src"), F.get("t", 1).alias("dst")))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``user<TAB>item<TAB>rating`` integers."""
    return spark.read.csv(path, sep="\t", schema="user long, item long, rating double",
                          mode="FAILFAST")


def read_vectors(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """Whitespace-separated floats per line -> ``(id, features)``, id =
    line number."""
    lines = read_lines_indexed(spark, path, "id")
    return lines.select("id", F.transform(java_split("value"),
                                          lambda x: _cast(x, "double", permissive))
                        .alias("features"))


def read_dense_matrix(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """Dense 0/1 (or int) matrix, row = line number -> sparse long form
    ``(row_id, col_id, value)`` with zeros dropped."""
    lines = read_lines_indexed(spark, path, "row_id")
    cells = lines.select("row_id", F.posexplode(F.split(rtrim_ws("value"), sep)).alias("col_id", "v"))
    return (cells.select("row_id", F.col("col_id").cast("long"),
                         F.col("v").cast("int").alias("value"))
            .filter(F.col("value") != 0))


def read_int_rows(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Dense integer features per line -> ``(row_id, features double[])``."""
    lines = read_lines_indexed(spark, path, "row_id")
    return lines.select("row_id", F.transform(F.split(rtrim_ws("value"), sep),
                                              lambda x: x.cast("double")).alias("features"))


def read_values(spark: SparkSession, path: str, to: str = "string") -> DataFrame:
    """One value per line (names or labels) -> ``(idx, value)``."""
    lines = read_lines_indexed(spark, path, "idx")
    v = rtrim_ws("value")
    return lines.select("idx", (v if to == "string" else v.cast(to)).alias("value"))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Exact counts ``id<TAB>count``."""
    return spark.read.csv(path, sep="\t", schema="event_id long, n long", mode="FAILFAST")


def read_item_counts(spark: SparkSession, path: str) -> DataFrame:
    """A previous stage's ``key<TAB>count`` output (item or ``a,b``)."""
    parts = F.split(F.col("value"), "\t")
    keys = F.split(F.get(parts, 0), ",")
    return spark.read.text(path).select(keys.alias("items"),
                                        F.get(parts, 1).cast("long").alias("n"))


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Centroids from the last tab column of each line; rows whose
    width differs from the first row's (e.g. a ``Loss`` summary row) are
    skipped.  ``(cluster, center)`` numbered by position."""
    lines = read_lines_indexed(spark, path, "idx")
    vec = lines.select("idx", F.element_at(F.split("value", "\t"), -1).alias("v"))
    vec = vec.select("idx", java_split("v").alias("t"))
    width = vec.filter(F.col("idx") == 0).select(F.size("t").alias("w"))
    kept = vec.join(F.broadcast(width), F.size("t") == F.col("w")).select("idx", "t")
    return with_global_index(kept, ["idx"], out="cluster").select(
        F.col("cluster").cast("int"), F.transform("t", lambda x: x.cast("double")).alias("center"))
