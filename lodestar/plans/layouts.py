"""Queries over the text layouts: each writes a table in one of the layouts below the
checkpoint folder and reads it back with that layout's reader (S2-S13, K2, K3), or checks an
edge case that the tables themselves don't hold (P8, J14, O2).

Lines are made row by row and sorted where their place is their meaning; no list is gathered
from a group.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import cluster as K
from lodestar.operators import recommend as R
from lodestar.operators import text as T
from lodestar.session import scratch_path
from lodestar.sources import sinks as IO
from lodestar.sources import tables as S
from lodestar.sources import text as X

TAB = "\t"


def _written(spark, name, df, *fields, order=()):
    """``df`` as lines of ``fields`` (columns, or strings that stand between them);
    returns their folder."""
    path = scratch_path(spark, name)
    df = df.orderBy(*order) if order else df
    df.select(F.concat(*[F.lit(f) if isinstance(f, str) else f.cast("string") for f in fields]).alias("value")).write.text(path)
    return path


def _lineitem(spark, sf_dir):
    return S.table(spark, sf_dir, "lineitem")


def q_adjacency_layout(spark, sf_dir):
    """An order's key and three neighbours; returned ('A') rows have no list."""
    friends = F.when(F.col("l_returnflag") != "A",
                     F.concat(F.lit(TAB), IO.composite_key("l_partkey", "l_suppkey", "l_linenumber"))).otherwise("")
    path = _written(spark, "adjacency", _lineitem(spark, sf_dir), F.col("l_orderkey"), friends)
    return X.adjacency_edges(X.read_adjacency(spark, path)).groupBy("src", "dst", "pos").agg(
        F.count(F.lit(1)).alias("n"))


def q_edges_tab_layout(spark, sf_dir):
    """S4."""
    path = _written(spark, "edges-tab", _lineitem(spark, sf_dir), F.col("l_partkey"), TAB, F.col("l_suppkey"))
    return X.read_edges_tab(spark, path).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def q_edges_ws_layout(spark, sf_dir):
    """Blanks in front, mixed between, a third token; events without a type are short."""
    second = F.when(F.col("event_type") != "click", F.concat(F.lit(" \t "), "event_type", F.lit("  x")))
    path = _written(spark, "edges-ws", S.table(spark, sf_dir, "events"), F.lit("  "), F.col("user_id"),
                    F.coalesce(second, F.lit(" ")))
    return X.read_edges_ws(spark, path).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def q_ratings_layout(spark, sf_dir):
    """S6."""
    path = _written(spark, "ratings", _lineitem(spark, sf_dir), F.col("l_orderkey"), TAB, F.col("l_partkey"), TAB,
                    F.col("l_quantity").cast("int"))
    return X.read_ratings(spark, path).groupBy("user", "item").agg(F.sum("rating").alias("rating"))


def q_vectors_layout(spark, sf_dir):
    """Line i is vector i."""
    path = _written(spark, "vectors", S.embeddings_points(spark, sf_dir), IO.vector_text("features"), order=["vec_id"])
    return X.read_vectors(spark, path).select("id", F.posexplode("features").alias("d", "x"))


def q_dense_matrix_layout(spark, sf_dir):
    """Toxic and quality as a two-column matrix; zeros are absent."""
    path = _written(spark, "matrix", S.table(spark, sf_dir, "labels"), F.col("toxic"), F.lit(" "), F.col("quality"),
                    order=["doc_id"])
    return X.read_dense_matrix(spark, path)


def q_int_rows_layout(spark, sf_dir):
    """S9."""
    path = _written(spark, "int-rows", S.table(spark, sf_dir, "labels"), F.col("toxic"), F.lit(","), F.col("quality"),
                    order=["doc_id"])
    return X.read_int_rows(spark, path).select("row_id", F.get("features", 0).alias("toxic"),
                                               F.get("features", 1).alias("quality"))


def q_names_layout(spark, sf_dir):
    """Names by line, joined to counted items."""
    path = _written(spark, "names", S.table(spark, sf_dir, "part"), F.col("p_name"), order=["p_partkey"])
    counted = _lineitem(spark, sf_dir).groupBy(F.col("l_partkey").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return R.with_names(counted, X.read_values(spark, path)).select("item", "n", "name")


def q_counts_layout(spark, sf_dir):
    """Counts of one stage read by the next, from several folders at once (a glob)."""
    base = scratch_path(spark, "counts")
    counts = S.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    for part in (0, 1):
        IO.write_kv_text(counts.filter(F.pmod("user_id", F.lit(2)) == part), "user_id", "n", f"{base}/part{part}")
    return X.read_counts(spark, f"{base}/part*")


def q_item_counts_layout(spark, sf_dir):
    """``a,b`` keys."""
    path = scratch_path(spark, "item-counts")
    pairs = _lineitem(spark, sf_dir).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    IO.write_kv_text(pairs.select(IO.composite_key("l_returnflag", "l_linestatus").alias("k"), "n"), "k", "n", path)
    return X.read_item_counts(spark, path).select(F.get("items", 0).alias("a"), F.get("items", 1).alias("b"), "n")


def q_centroids_layout(spark, sf_dir):
    """The greatest component per label and dimension as centroids, then a Loss row."""
    pts = S.embeddings_points(spark, sf_dir).select("label", F.posexplode("features").alias("d", "x"))
    top = pts.groupBy("label", "d").agg(F.max("x").alias("x"))
    rows = top.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("v")).select(
        "label", F.transform("v", lambda p: p["x"]).alias("v"))     # labels x dimensions: model-sized
    loss = rows.agg(F.max("label").alias("label"), F.count(F.lit(1)).alias("n")).select(
        F.col("label") + 1, F.concat(F.lit("Loss"), F.lit(TAB), F.col("n").cast("string")))
    lines = rows.select("label", F.concat(F.col("label").cast("string"), F.lit(TAB), IO.vector_text("v")).alias("line"))
    path = _written(spark, "centroids", lines.union(loss), F.col("line"), order=["label"])
    return X.read_centroids(spark, path).select("cluster", F.posexplode("center").alias("d", "x"))


def q_iterations_layout(spark, sf_dir):
    """K3: a folder a round; a round written again replaces its own folder alone."""
    path = scratch_path(spark, "iterations")
    counts = _lineitem(spark, sf_dir).groupBy(F.col("l_linenumber").alias("iteration"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"))
    IO.write_iterations(counts, path)
    IO.write_iterations(counts.filter("iteration = 1").withColumn("n", -F.col("n")), path)
    return spark.read.parquet(path).select(F.col("iteration").cast("int"), "l_returnflag", "n")


def q_sorted_part_files(spark, sf_dir):
    """O2: the lines of all part files, in file order, are in key order."""
    path = scratch_path(spark, "sorted")
    IO.write_kv_text(T.word_count(S.documents_text(spark, sf_dir)), "token", "n", path)
    return X.read_lines_indexed(spark, path).select("idx", F.get(F.split("value", "\t"), 0).alias("token"))


def q_single_sorted_file(spark, sf_dir):
    """K2: one file, for a result of a few rows a letter."""
    path = scratch_path(spark, "single")
    IO.write_kv_text(T.first_letter_count(S.documents_text(spark, sf_dir)), "letter", "n", path, single_file=True)
    lines = X.read_lines_indexed(spark, path).withColumn("t", F.split("value", "\t"))
    files = spark.read.text(path).select(F.count_distinct("_metadata.file_path")).first()[0]
    return lines.select("idx", F.get("t", 0).alias("letter"), F.get("t", 1).cast("long").alias("n"),
                        F.lit(files).cast("long").alias("files"))


def q_kmeans_assign_nan(spark, sf_dir):
    """Points with a component that is no number have no nearest centroid."""
    pts = S.embeddings_points(spark, sf_dir)
    centers = K.initial_centers(pts, list(range(10)))
    odd = F.when(F.col("vec_id") % 7 == 3, F.transform("features", lambda x: x * F.lit(float("nan")))).otherwise(
        F.col("features"))
    return K.kmeans_assign(pts.withColumn("features", odd), centers).select(
        "vec_id", "cluster", F.round("dist", 6).alias("dist"))


QUERIES = {name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")}
