"""Parquet test tables and the inputs each operator family derives from
them (FIXTURES §2).  Every derivation is a lazy DataFrame over the whole
table; projections are selected early so the parquet scan reads only the
columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.baskets import basket_items
from lodestar.operators.sequence import with_global_next

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

BASKET_COLS = ("conv_id", "turn")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text corpus: one row per document, column ``value``."""
    return table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def conversation_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets: one per ``(conv_id, turn)``, items = distinct tokens."""
    conv = table(spark, sf_dir, "conversations").select(*BASKET_COLS, "text")
    return basket_items(conv, BASKET_COLS, "text")


def conversation_count(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "conversations").count()


def succession_graph(spark: SparkSession, sf_dir: str, event_type: str | None = None) -> DataFrame:
    """Directed graph ``(src, dst)`` of consecutive events' users.

    Events are ordered by ``(ts, event_id)``; each user points to the user
    of the next event (optionally only events of one type).  Self pairs are
    dropped and edges de-duplicated (U1).
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    if event_type is not None:
        ev = ev.filter(F.col("event_type") == event_type)
    seq = with_global_next(ev.select("ts", "event_id", "user_id"), ["ts", "event_id"],
                           ["user_id"])
    return (seq.select(F.col("user_id").alias("src"), F.col("next_user_id").alias("dst"))
            .filter(F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
            .dropDuplicates(["src", "dst"]))


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, de-duplicated: symmetric friendship."""
    return (edges.select("src", "dst")
            .unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
            .dropDuplicates(["src", "dst"]))


def embeddings_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points ``(vec_id, features array<double>, label)``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def purchase_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0/1 user x item matrix, long form ``(user, item)``: distinct
    ``(o_custkey, l_partkey)`` (zeros are absent rows)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (items.join(orders, items.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .dropDuplicates(["user", "item"]))


def quantity_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings ``(user, item, rating)``: mean quantity per (customer, part)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (items.join(orders, items.l_orderkey == orders.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.avg("l_quantity").alias("rating")))
