"""Grouped element-wise sums of fixed-width vectors.

Narrow vectors become one ``sum(v[d])`` aggregate per dimension in a
single pass (whole-stage codegen, partial aggregation).  Wide vectors --
where hundreds of aggregate expressions would blow up code generation --
are exploded to ``(key, d, x)`` and summed per ``(key, d)``, again with
partial aggregation.  Either way only ``groups x dim`` numbers reach the
driver: model state, not data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDE_DIM = 256


def vector_sums(df: DataFrame, vec: str, dim: int, keys: Sequence[str] = (),
                weight: Column | None = None, extra: Sequence[Column] = ()):
    """Return ``(sums, extras)``: ``sums[key_tuple]`` is the list of
    per-dimension sums of ``weight * vec``; ``extras[key_tuple]`` the
    values of the ``extra`` aggregate columns (by alias)."""
    w = weight if weight is not None else F.lit(1.0)
    if dim <= WIDE_DIM:
        aggs = [F.sum(F.col(vec)[d] * w).alias(f"_s{d}") for d in range(dim)]
        rows = df.groupBy(*keys).agg(*extra, *aggs).collect()
        sums, extras = {}, {}
        for r in rows:
            k = tuple(r[c] for c in keys)
            sums[k] = [r[f"_s{d}"] or 0.0 for d in range(dim)]
            extras[k] = r.asDict()
        return sums, extras
    extras = {}
    if extra:
        for r in df.groupBy(*keys).agg(*extra).collect():
            extras[tuple(r[c] for c in keys)] = r.asDict()
    long = df.select(*keys, w.alias("_w"), F.posexplode(vec).alias("_d", "_x"))
    sums: dict = {}
    for r in long.groupBy(*keys, "_d").agg(F.sum(F.col("_x") * F.col("_w")).alias("_s")).collect():
        k = tuple(r[c] for c in keys)
        sums.setdefault(k, [0.0] * dim)[r["_d"]] = r["_s"] or 0.0
    for k in extras:
        sums.setdefault(k, [0.0] * dim)
    return sums, extras
