"""Mixing sources to target weights (operator 3): weighted fair queueing.

Sizes are words. Sources in code point order (null last) get the weights of a
repeating cycle; together they may take ``share`` of all words, and a source
at most ``repeats`` times its own. The targets are a water level: with level L
a source gets min(repeats * size, L * weight), and L is raised until the
targets fill the budget. Each round of that takes two sums over the table of
sources, so no table passes through the driver.

Within its source a document is placed by a hash of its id. Its virtual finish
time is the source's words up to and including it, divided by the source's
target; a further copy follows a whole pass over the source later. A document
is queued in packets of ``packet`` words, so a very long one can't push its
source far past its share. All packets are range-sorted by finish time, and
the queue is cut at the budget: the ranges before the cut are taken whole, the
ranges after it not at all, and only the range with the cut is counted packet
by packet. Prefix sums go by (source, hash bucket): a source with a third of
all rows is spread over as many buckets as any other.

Null texts have size 0; documents of size 0 are never taken. Order ties fall
to source, then place, so reruns agree. Rows that repeat an id are documents
of their own, and the earlier of two is not told apart where they are equal in
every column used. Empty tables give no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lodestar.llm.common import WORD, shuffle_partitions, written
from lodestar.operators.sequence import with_global_index

#: Weights by the source's position in code point order, repeating.
WEIGHTS = (3, 1, 2)
PACKET_WORDS = 256


def words(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
                   repeats: int = 2) -> DataFrame:
    """``sizes`` (source, size) -> one row per source: source, source_ix,
    source_size, target."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = total.withColumn("_last", F.col("source").isNull())
    cycle = F.array(*map(F.lit, weights))
    table = written(
        with_global_index(total, ["_last", "source"], "source_ix")
        .select("source", "source_ix", "source_size",
                F.get(cycle, (F.col("source_ix") % len(weights)).cast("int")).cast("double").alias("weight")),
        "mix-sources")
    cap = (F.col("source_size") * repeats).cast("double")
    budget = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:  # at least one more source is full after each round but the last
        full = cap <= F.col("weight") * level
        n, used, open_weight = table.agg(F.count_if(full), F.sum(F.when(full, cap)),
                                         F.sum(F.when(~full, F.col("weight")))).first()
        if n == capped or not open_weight:
            break
        level, capped = (budget - (used or 0.0)) / open_weight, n
    return table.select("source", "source_ix", "source_size",
                        F.least(cap, F.col("weight") * level).alias("target"))


def places(base: DataFrame, buckets: int) -> DataFrame:
    """Add ``before``: the words of the source that stand before the row."""
    rows = base.withColumn("bucket", F.shiftrightunsigned(F.shiftrightunsigned("place", 40) * buckets, 24))
    sums = rows.groupBy("source_ix", "bucket").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source_ix").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_ix", "bucket", F.coalesce(F.sum("words").over(up_to), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("source_ix", "bucket").orderBy("place", "key", "size", "rid")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.join(offsets, ["source_ix", "bucket"])
            .withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .drop("bucket", "offset"))


def queued(placed: DataFrame, repeats: int, packet: int) -> DataFrame:
    """Packets: rid, words and the columns of the queue's order."""
    copies = placed.filter("size > 0 and target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    return (copies.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(packet).cast("long"))))
            .withColumn("words", F.least(F.lit(packet).cast("long"), F.col("size") - F.col("at")))
            .select("rid", "words", "source_ix", "place", "key", "copy", "at",
                    ((F.col("copy") * F.col("source_size") + F.col("before") + F.col("at") + F.col("words"))
                     / F.col("target")).alias("finish")))


def fair_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[int] = WEIGHTS, share: float = 1.5, repeats: int = 2,
             packet: int = PACKET_WORDS, carry: Sequence[str] = (), seed: int = 7) -> DataFrame:
    """Per row: key, ``carry``, size, source_size, target, taken (words the mix
    takes of the document, copies counted)."""
    n = shuffle_partitions(docs.sparkSession)
    base = written(docs.select(
        F.col(key).cast("long").alias("key"), F.col(source).alias("source"), words(text).alias("size"),
        F.xxhash64(F.lit(seed), F.col(key)).alias("place"), F.struct(*map(F.col, carry)).alias("more") if carry
        else F.lit(None).cast("int").alias("more")).withColumn("rid", F.monotonically_increasing_id()), "mix-sizes")
    targets = written(source_targets(base.select("source", "size"), weights, share, repeats), "mix-targets")
    known = base.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    order = ["finish", "source_ix", "copy", "place", "key", "at", "rid"]
    slim = known.select("rid", "key", "size", "place", "source_ix", "source_size", "target")
    queue = written(queued(places(slim, 4 * n), repeats, packet).repartitionByRange(n, *order)
                    .withColumn("range", F.spark_partition_id()), "mix-queue")
    budget = int((targets.agg(F.sum("source_size")).first()[0] or 0) * share)
    sums = queue.groupBy("range").agg(F.sum("words").alias("words")).orderBy("range").collect()  # n rows at most
    cut, left = n, budget
    for r in sums:
        if r.words > left:
            cut = r.range
            break
        left -= r.words
    running = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = (queue.filter(F.col("range") == cut)
            .withColumn("got", F.lit(left) - F.coalesce(F.sum("words").over(running), F.lit(0)))
            .select("rid", F.greatest(F.lit(0), F.least("words", "got")).alias("words")))
    taken = (queue.filter(F.col("range") < cut).select("rid", "words").unionAll(last)
             .groupBy("rid").agg(F.sum("words").alias("taken")))
    return known.join(taken, "rid", "left").select(
        F.col("key").alias(key), *[F.col(f"more.{c}").alias(c) for c in carry], "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per copy taken. The
    document that the budget cuts keeps its first words, with one space between
    them, in its last copy. Rows equal in every column are one with a number,
    and each share of it is given out; extra columns may have any name."""
    plain = [f.name for f in docs.schema if not _has_map(f.dataType)]
    tagged = docs.select(F.xxhash64(*plain).alias("_a"), F.xxhash64(F.lit(1), *reversed(plain)).alias("_b"), F.col(key).alias("_key"),
                         F.col(text).alias("_text"), F.col(source).alias("_source"), F.struct("*").alias("_row"))
    shares = written(fair_mix(tagged, "_key", "_text", "_source", carry=["_a", "_b"], **how)
                     .groupBy("_a", "_b", "size", "taken").agg(F.count("*").alias("times")), "mix-shares")
    many = written(shares.groupBy("_a", "_b").agg(F.sum("times").alias("rows")).filter("rows > 1").select("_a", "_b"), "mix-many")
    taken = shares.filter("taken > 0").withColumn("last", F.ceil(F.col("taken") / F.col("size")).cast("long"))
    out = tagged.join(taken.join(many, ["_a", "_b"], "left_anti"), ["_a", "_b"])
    if not many.isEmpty():
        one_each = tagged.join(many, ["_a", "_b"], "left_semi").dropDuplicates(["_a", "_b"])
        out = out.unionByName(one_each.join(taken, ["_a", "_b"]).withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))))
    copies = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "last")))
    rest = (F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    first_words = F.array_join(F.slice(F.regexp_extract_all(F.col("_text"), F.lit(f"({WORD})"), F.lit(1)), 1, F.greatest(rest, F.lit(1))), " ")
    cut = F.when(rest < F.col("size"), first_words).otherwise(F.col("_text"))
    return copies.select(*[cut.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns])


def _has_map(kind: DataType) -> bool:
    return "map<" in kind.simpleString() or kind.simpleString() == "variant"
