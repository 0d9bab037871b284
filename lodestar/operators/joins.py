"""Positional (zip) join of line-aligned files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.sources.text import read_lines_indexed


def positional_join(left: DataFrame, right: DataFrame, on: str = "idx") -> DataFrame:
    """Join two indexed frames row by row; different lengths are an error.

    Both sides carry a distributed line index, so the zip is an ordinary
    equi-join on a unique key (no skew, no single task).
    """
    n_left, n_right = left.count(), right.count()
    if n_left != n_right:
        raise ValueError(f"positional join of unequal lengths: {n_left} != {n_right}")
    return left.join(right, on)


def zip_text_files(spark: SparkSession, path_a: str, path_b: str,
                   names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """``(idx, a, b)``: line i of the files under ``path_a`` with line i of
    those under ``path_b``."""
    a = read_lines_indexed(spark, path_a).withColumnRenamed("value", names[0])
    b = read_lines_indexed(spark, path_b).withColumnRenamed("value", names[1])
    return positional_join(a, b)
