"""Counting jobs over text lines: word count (M1), first-letter count
(M2) and distinct records per key (M3).

Each is one narrow projection (split + explode) followed by one hash
aggregation; Spark's partial aggregation is the map-side combiner, so a hot
token that occurs in a third of all lines costs one row per partition in
the shuffle, not one row per occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import java_split


def tokens(df: DataFrame, col: str = "value", keep_empty: bool = True,
           out: str = "token") -> DataFrame:
    """One row per whitespace token (Java split rules, F1)."""
    toks = java_split(col)
    if not keep_empty:
        toks = F.filter(toks, lambda t: t != "")
    return df.select(F.explode(toks).alias(out))


def word_count(df: DataFrame, col: str = "value", keep_empty: bool = True) -> DataFrame:
    """M1: ``(token, n)``; N1 keeps the empty token of leading blanks."""
    return tokens(df, col, keep_empty).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


# A token starts at the beginning of the line or after one whitespace
# character; skip its leading non-letters and capture its first ASCII letter.
# Tokens without a letter never match, and each token matches at most once.
_FIRST_LETTER_OF_TOKEN = r"(?:^|\s)[^A-Za-z\s]*([A-Za-z])"


def first_letter_count(df: DataFrame, col: str = "value") -> DataFrame:
    """M2: ``(letter, n)``: lower-cased first ASCII letter of each token;
    tokens without any ASCII letter are skipped (P4).

    One regex pass per line extracts the letters directly, so the tokens
    themselves are never materialised as rows.
    """
    letters = df.select(F.explode(F.regexp_extract_all(F.col(col), F.lit(_FIRST_LETTER_OF_TOKEN),
                                                       1)).alias("c"))
    return letters.groupBy(F.lower("c").alias("letter")).agg(F.count(F.lit(1)).alias("n"))


def split_records(df: DataFrame, col: str = "value", strict: bool = False) -> DataFrame:
    """Token 0 is the key, tokens 2 and 3 concatenated (F8) the value.

    Lines of fewer than four tokens are left out -- ``short_records`` counts
    them -- or raise when ``strict`` (N2; ANSI ``element_at`` out of range
    raises inside the task).
    """
    parts = java_split(col)
    if strict:
        return df.select(F.element_at(parts, 1).alias("key"),
                         F.concat(F.element_at(parts, 3), F.element_at(parts, 4)).alias("value"))
    return (df.select(parts.alias("p")).filter(F.size("p") >= 4)
            .select(F.get("p", 0).alias("key"),
                    F.concat(F.get("p", 2), F.get("p", 3)).alias("value")))


def short_records(df: DataFrame, col: str = "value", tokens: int = 4) -> DataFrame:
    """One row ``(n_lines, n_short)``: lines, and lines with too few tokens
    for ``split_records`` (or, with ``tokens=2``, for an edge list)."""
    short = F.size(java_split(col)) < tokens
    return df.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.coalesce(short, F.lit(True))).alias("n_short"))


def distinct_count_per_key(df: DataFrame, key: str | Column = "key",
                           value: str | Column = "value", out_key: str | None = None) -> DataFrame:
    """M3/A3: number of distinct values per key.

    Planned as a two-level aggregation (dedupe on ``(key, value)``, then
    count per key), so a single hot key is spread over the first shuffle.
    """
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    name = out_key or (key if isinstance(key, str) else "key")
    return (df.select(k.alias(name), v.alias("_v"))
            .groupBy(name).agg(F.count_distinct("_v").alias("n")))


#: Precision of the distinct sketches: 2**HLL_LG registers a key, a relative
#: standard error of about 1.04 / sqrt(2**HLL_LG); counts up to some hundreds are exact.
HLL_LG = 12


def distinct_sketch(df: DataFrame, key: str | Column = "key", value: str | Column = "value") -> DataFrame:
    """A3/A23, mergeable: ``(key, sketch)`` of the distinct values per key. A
    sketch has a bounded size, so that a part's sketches can be written once and
    merged with those of later parts; partial aggregation keeps one per task."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return (df.select(k.alias("key"), v.cast("string").alias("_v"))
            .groupBy("key").agg(F.hll_sketch_agg("_v", F.lit(HLL_LG)).alias("sketch")))


def merge_sketches(*parts: DataFrame) -> DataFrame:
    """The sketches of all parts together, ``(key, sketch)``."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("key").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_estimate(sketches: DataFrame) -> DataFrame:
    """``(key, n)``: the estimated number of distinct values."""
    return sketches.select("key", F.hll_sketch_estimate("sketch").alias("n"))


def sketch_error(sigmas: float = 3.0) -> float:
    """The relative error that an estimate stays within, ``sigmas`` standard errors."""
    return sigmas * 1.04 / (1 << HLL_LG) ** 0.5
