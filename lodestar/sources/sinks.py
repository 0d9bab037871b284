"""Sinks in the reference's text layouts (K1-K5).

Parquet stays the default table format; these writers produce the
``key<TAB>value`` files other tools expect.  Global order is a range
partition + sort (no single reducer); ``coalesce(1)`` is offered only for
results whose size is bounded by a parameter (K2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A null field in ``key<TAB>value`` lines.
NULL_TEXT = "\\N"


def write_kv_text(df: DataFrame, key: str, value: str | Column, path: str,
                  single_file: bool = False, mode: str = "error") -> None:
    """K1: ``key<TAB>value`` lines sorted by key across part files.

    The value is a secondary sort key so that the range partitioner can
    split a key that holds a large share of the rows. A null key or value is
    written as ``NULL_TEXT``, so the line keeps both fields. An existing folder
    is an error unless ``mode`` says otherwise.
    """
    v = F.col(value) if isinstance(value, str) else value
    out = df.select(F.col(key).alias("_k"), v.cast("string").alias("_v")).orderBy("_k", "_v")
    if single_file:
        out = out.coalesce(1)
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in ("_k", "_v")]
    out.select(F.concat(shown[0], F.lit("\t"), shown[1]).alias("value")).write.mode(mode).text(path)


def read_kv_text(spark, path: str, key_type: str = "string",
                 value_type: str = "long") -> DataFrame:
    """Read K1 output back as ``(key, value)``."""
    parts = F.split(F.col("value"), "\t", 2)
    key, value = (F.when(F.get(parts, i) != NULL_TEXT, F.get(parts, i)) for i in (0, 1))
    return spark.read.text(path).select(key.cast(key_type).alias("key"), value.cast(value_type).alias("value"))


def composite_key(*cols: str, sep: str = ",") -> Column:
    """K4: ``a,b`` / ``a,b,c`` keys."""
    return F.concat_ws(sep, *[F.col(c) for c in cols])


def rule_key(lhs: list[str], rhs: str) -> Column:
    """K4: ``a->b`` / ``a,b->c``."""
    return F.concat(composite_key(*lhs), F.lit("->"), F.col(rhs))


def list_value(col: str) -> Column:
    """K5: list-valued cell ``a,b,c``; empty or missing list -> ``''``."""
    return F.coalesce(F.array_join(F.col(col).cast("array<string>"), ","), F.lit(""))


def vector_text(col: str) -> Column:
    """space-separated numbers with a trailing space."""
    return F.concat(F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), " "),
                    F.lit(" "))


def write_iterations(df: DataFrame, path: str, iteration_col: str = "iteration") -> None:
    """K3: one folder per round, ``<path>/iteration=<i>``. A round that is
    written again replaces its own folder and leaves the others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(iteration_col).parquet(path))
