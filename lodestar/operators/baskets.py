"""Market-basket mining by A-priori (M4) and association rules (M5).

Plan shape, one level per shuffle:

* items:   explode the distinct items of each basket (narrow) and count
           baskets per item with partial aggregation (one shuffle on item).
* pairs:   keep only occurrences of frequent items (a semi join against the
           frequent-item table, broadcast behind a row-count check), then a
           theta self-join on the basket with ``a < b`` (one shuffle on the
           basket) and a partially aggregated count (one shuffle on a, b).
* triples: frequent pairs per basket joined on ``(basket, a)`` with
           ``b < c`` and a semi join on ``(b, c)``; triples are only ever
           built from frequent pairs, the A-priori pruning.

Because items are pruned to frequent ones before any pair is formed, a
basket holding m frequent items yields m(m-1)/2 pair rows, bounded by the
size of the frequent-item set, not by the basket length. The pairs of a basket of
more than ``BLOCK_ITEMS`` such items are made in cells, each by a task of its own. Where the frequent items allow more pairs than ``PAIR_BUCKETS``, a
first pass counts hashed pairs and its bitmap drops pairs before they are counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import split_nonempty
from lodestar.plans.guards import bounded_broadcast


def support_threshold(n_baskets: int, fraction: float = 0.186, floor: int = 2) -> int:
    """Support as a fraction of the basket count: ``max(floor, ceil(f*n))``."""
    return max(floor, math.ceil(fraction * n_baskets))


def basket_items(df: DataFrame, basket_cols: Sequence[str], text_col: str = "text") -> DataFrame:
    """Long form ``(*basket_cols, item)``: distinct non-empty tokens."""
    return df.select(*basket_cols,
                     F.explode(F.array_distinct(split_nonempty(text_col))).alias("item"))


def item_support(items: DataFrame, min_support: int) -> DataFrame:
    """A4: ``(item, n)`` with n baskets containing the item, n >= support."""
    return (items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_support))


def _frequent_occurrences(items: DataFrame, freq_items: DataFrame) -> DataFrame:
    keys = bounded_broadcast(freq_items.select("item"))
    return items.join(keys, "item", "left_semi")


#: Items of a basket whose pairs one task makes; larger ones are cut into blocks.
BLOCK_ITEMS = 2048


def _plain_pairs(occ: DataFrame, keys: Sequence[str]) -> DataFrame:
    x = occ.select(*keys, F.col("item").alias("item_a"))
    y = occ.select(*keys, F.col("item").alias("item_b"))
    return x.join(y, list(keys)).filter(F.col("item_a") < F.col("item_b"))


#: Pairs that a task makes or counts, on average, where pairs are many.
TASK_PAIRS = 1 << 21


def _tasks(occ: DataFrame, basket_cols: Sequence[str]) -> int:
    """Tasks for the pairs of all baskets; 0 if the usual number will do."""
    m = F.count(F.lit(1)).cast("double")
    pairs = occ.groupBy(*basket_cols).agg((m * (m - 1) / 2).alias("_p")).agg(F.sum("_p")).first()[0] or 0.0
    tasks = math.ceil(pairs / TASK_PAIRS)
    return tasks if tasks > int(occ.sparkSession.conf.get("spark.sql.shuffle.partitions")) else 0


def _basket_pairs(occ: DataFrame, basket_cols: Sequence[str], block: int | None = None) -> DataFrame:
    """``(*basket, item_a, item_b)`` for ``item_a < item_b`` in a basket.

    A basket of m items has m(m-1)/2 pairs. If m is over ``block``, its items are
    hashed into g = ceil(m / block) blocks and its pairs come from g(g+1)/2 cells
    (i <= j), each a join key of its own: an item has a row in the g cells of its
    block, and a cell makes the pairs between its two blocks (those within a
    block in cell (i, i) alone). So no task makes more than about 2 * block**2 / 2
    pairs of one basket, and each pair is made once.
    """
    cols, block = list(basket_cols), block or BLOCK_ITEMS
    hot = (occ.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > block)
           .select(*cols, F.ceil(F.col("_m") / block).cast("int").alias("_g"))).persist()
    if hot.isEmpty():
        hot.unpersist()
        return _plain_pairs(occ, cols)
    cold = _plain_pairs(occ.join(hot.select(*cols), cols, "left_anti"), cols)
    cells = (occ.join(hot, cols).withColumn("_b", F.pmod(F.xxhash64("item"), F.col("_g")).cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
             .withColumns({"_i": F.least("_b", "_o"), "_j": F.greatest("_b", "_o")}))
    keys = [*cols, "_i", "_j"]
    x = cells.select(*keys, F.col("item").alias("item_a"), F.col("_b").alias("_ba"))
    y = cells.select(*keys, F.col("item").alias("item_b"), F.col("_b").alias("_bb"))
    pairs = x.join(y, keys).filter((F.col("item_a") < F.col("item_b"))
                                   & ((F.col("_ba") != F.col("_bb")) | (F.col("_i") == F.col("_j"))))
    return cold.unionByName(pairs.select(*cols, "item_a", "item_b"))


#: Buckets of hashed pairs (a power of two, at least 64). The bitmap has one bit a bucket.
PAIR_BUCKETS = 1 << 22


def pair_bitmap(pairs: DataFrame, min_support: int, buckets: int) -> DataFrame:
    """``(word, bits)``: bit ``h % 64`` of word ``h / 64`` is set if the pairs that hash
    to bucket h number at least ``min_support``. A frequent pair's bucket always does.
    A task sends at most ``buckets`` counts; the bitmap has at most ``buckets / 64`` rows."""
    full = (pairs.groupBy(_pair_bucket(buckets).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_support))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_h", F.lit(64)).cast("int"))
    return full.groupBy(F.shiftright("_h", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _pair_bucket(buckets: int):
    return F.pmod(F.xxhash64("item_a", "item_b"), F.lit(buckets))


def _in_bitmap(pairs: DataFrame, bitmap: DataFrame, buckets: int) -> DataFrame:
    h = pairs.withColumn("_h", _pair_bucket(buckets))
    bitmap = F.broadcast(bitmap.withColumnRenamed("bits", "_bits").withColumnRenamed("word", "_word"))
    hit = F.call_function("getbit", F.col("_bits"), F.pmod("_h", F.lit(64)).cast("int")) == 1
    return (h.join(bitmap, F.shiftright("_h", 6) == F.col("_word")).filter(hit)
            .drop("_h", "_word", "_bits"))


def pair_support(items: DataFrame, basket_cols: Sequence[str], min_support: int,
                 freq_items: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """A5: ``(item_a, item_b, n)`` for frequent pairs, ``item_a < item_b``.

    f frequent items allow f(f-1)/2 pairs, and a task's partial counts hold as many rows.
    Up to ``buckets`` of them are counted at once. Beyond, pairs are hashed and counted by
    bucket first; only pairs of buckets that reach the support (``pair_bitmap``) are
    counted by name, so pairs that can't be frequent never reach the shuffle. Both
    ways give the same rows. There, tasks are as many as their pairs take
    (``TASK_PAIRS``): what one holds does not grow with the table.
    """
    buckets = buckets or PAIR_BUCKETS
    if buckets < 64 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two, at least 64")
    if freq_items is None:
        freq_items = item_support(items, min_support).persist()
    occ = _frequent_occurrences(items, freq_items)
    f = freq_items.count()
    many = f * (f - 1) // 2 > buckets
    tasks = _tasks(occ, basket_cols) if many else 0
    pairs = _basket_pairs(occ.repartition(tasks, *basket_cols) if tasks else occ, basket_cols)
    if many:
        pairs = _in_bitmap(pairs, pair_bitmap(pairs, min_support, buckets), buckets)
        if tasks:
            pairs = pairs.repartition(tasks, "item_a", "item_b")
    return (pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_support))


def triple_support(items: DataFrame, basket_cols: Sequence[str], min_support: int,
                   freq_items: DataFrame | None = None,
                   freq_pairs: DataFrame | None = None) -> DataFrame:
    """``(item_a, item_b, item_c, n)`` for frequent triples."""
    if freq_items is None:
        freq_items = item_support(items, min_support).persist()
    if freq_pairs is None:
        freq_pairs = pair_support(items, basket_cols, min_support, freq_items).persist()
    pair_keys = bounded_broadcast(freq_pairs.select("item_a", "item_b"))
    bp = (_basket_pairs(_frequent_occurrences(items, freq_items), basket_cols)
          .join(pair_keys, ["item_a", "item_b"], "left_semi"))
    ab = bp
    ac = bp.withColumnRenamed("item_b", "item_c")
    cands = (ab.join(ac, list(basket_cols) + ["item_a"])
             .filter(F.col("item_b") < F.col("item_c")))
    bc_keys = pair_keys.select(F.col("item_a").alias("item_b"), F.col("item_b").alias("item_c"))
    cands = cands.join(bc_keys, ["item_b", "item_c"], "left_semi")
    return (cands.groupBy("item_a", "item_b", "item_c").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_support))


def pair_rules(pairs: DataFrame, item_counts: DataFrame) -> DataFrame:
    """M5: two rules per frequent pair, ``confidence = n / n(lhs)``.

    Output ``(rule, lhs, rhs, n, confidence)`` with ``rule = 'lhs->rhs'`` (K4).
    Both directions come from one pass (U2 via ``inline``).
    """
    both = pairs.select(
        "n",
        F.inline(F.array(
            F.struct(F.col("item_a").alias("lhs"), F.col("item_b").alias("rhs")),
            F.struct(F.col("item_b").alias("lhs"), F.col("item_a").alias("rhs")))))
    counts = bounded_broadcast(item_counts.select(F.col("item").alias("lhs"),
                                                  F.col("n").alias("lhs_n")))
    return (both.join(counts, "lhs")
            .select(F.concat("lhs", F.lit("->"), "rhs").alias("rule"), "lhs", "rhs", "n",
                    (F.col("n") / F.col("lhs_n")).alias("confidence")))


def triple_rules(triples: DataFrame, pair_counts: DataFrame) -> DataFrame:
    """M5: three rules per frequent triple, 2-item antecedent.

    Output ``(rule, n, confidence)`` with ``rule = 'x,y->z'``.
    """
    three = triples.select(
        "n",
        F.inline(F.array(
            F.struct(F.col("item_a").alias("x"), F.col("item_b").alias("y"),
                     F.col("item_c").alias("z")),
            F.struct(F.col("item_a").alias("x"), F.col("item_c").alias("y"),
                     F.col("item_b").alias("z")),
            F.struct(F.col("item_b").alias("x"), F.col("item_c").alias("y"),
                     F.col("item_a").alias("z")))))
    counts = bounded_broadcast(pair_counts.select(F.col("item_a").alias("x"),
                                                  F.col("item_b").alias("y"),
                                                  F.col("n").alias("lhs_n")))
    return (three.join(counts, ["x", "y"])
            .select(F.concat("x", F.lit(","), "y", F.lit("->"), "z").alias("rule"), "n",
                    (F.col("n") / F.col("lhs_n")).alias("confidence")))


def rules_as_float32(rules: DataFrame) -> DataFrame:
    """Reference-exact float32 confidences (Spark divides floats in double)."""
    return rules.withColumn("confidence", F.col("confidence").cast("float"))


def basket_arrays(df: DataFrame, basket_cols: Sequence[str], text_col: str = "text") -> DataFrame:
    """Baskets as rows ``(*basket_cols, items)`` of distinct non-empty tokens."""
    return df.select(*basket_cols, F.array_distinct(split_nonempty(text_col)).alias("items"))


def frequent_itemsets(baskets: DataFrame, min_support: int, n_baskets: int,
                      items_col: str = "items") -> DataFrame:
    """M4 beyond triples: all frequent itemsets of any size with Spark ML's
    parallel FP-growth.  Output ``(items array<string> sorted, n)``.

    FP-growth takes a fraction; ``(s - 0.5) / n`` makes its
    ``ceil(fraction * n)`` equal the integer support s exactly.
    """
    from pyspark.ml.fpm import FPGrowth

    fp = FPGrowth(itemsCol=items_col, minSupport=(min_support - 0.5) / max(1, n_baskets),
                  minConfidence=1.0)
    model = fp.fit(baskets.select(items_col))
    return (model.freqItemsets
            .select(F.array_sort("items").alias("items"), F.col("freq").alias("n"))
            .filter(F.col("n") >= min_support))
