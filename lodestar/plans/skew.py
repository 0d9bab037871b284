"""Hot-key splitting for joins whose big side is not re-shuffled per use.

AQE's skew-join rule splits oversized *shuffle* partitions at run time, so
ordinary shuffle joins are covered by ``spark.sql.adaptive.skewJoin``.  A
side that is cached once and joined every round (the edge list of an
iterative graph algorithm), or a self-join whose output is quadratic in a
key's size (two-hop paths through a hub), is salted explicitly:

* ``hot_keys`` finds keys holding more than half an average partition's
  share of rows -- at most ``2 * parts`` keys, so the list is bounded by
  the partition count and travels as a literal -- and gives each a salt
  count proportional to its size (about one average partition per salt),
  so the total replication of the small side stays below ``parts``;
* the big side spreads a hot key over its salts by a hash of another
  column; the small side repeats the hot key's row once per salt.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class HotKeys:
    keys: list = field(default_factory=list)
    buckets: list = field(default_factory=list)
    key_type: str = "bigint"

    def __bool__(self) -> bool:
        return bool(self.keys)

    def salts(self, key: str) -> Column:
        """Salt count of ``key``'s value; null for keys that are not hot."""
        table = F.map_from_arrays(F.lit(self.keys).cast(f"array<{self.key_type}>"),
                                  F.lit(self.buckets).cast("array<int>"))
        return F.element_at(table, F.col(key))


def hot_keys(df: DataFrame, key: str, parts: int | None = None, power: int = 1) -> HotKeys:
    """Keys that make more than ``total / (2 * parts)`` of the output, with
    salt counts.  A key of n rows makes ``n ** power`` of it: 1 for a join
    with unique keys, 2 for a self-join."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = df.groupBy(key).agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(float(power))).alias("_n"))
    total = made.agg(F.sum("_n")).first()[0] or 0.0
    piece = max(1.0, total / parts)
    limit = max(1.0, total / (2 * parts))
    hot = made.filter(F.col("_n") > limit).collect()  # 2 * parts keys at most
    key_type = df.schema[key].dataType.simpleString()
    return HotKeys([r[key] for r in hot],
                   [min(parts, max(2, math.ceil(r["_n"] / piece))) for r in hot], key_type)


def salt_big(key: str, hot: HotKeys, spread_by: str) -> Column:
    """Salt for the big side: a hash bucket for hot keys, 0 otherwise."""
    if not hot:
        return F.lit(0)
    n = hot.salts(key)
    return F.when(n.isNotNull(), F.pmod(F.xxhash64(spread_by), n)).otherwise(F.lit(0)).cast("int")


def salt_small(key: str, hot: HotKeys) -> Column:
    """Salts for the small side: every bucket for hot keys, 0 otherwise
    (use with ``explode``)."""
    if not hot:
        return F.array(F.lit(0))
    n = hot.salts(key)
    return F.when(n.isNotNull(), F.sequence(F.lit(0), n - 1)).otherwise(F.array(F.lit(0)))
