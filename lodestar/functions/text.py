"""String column functions (F1-F9).  All are built-in expressions, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Java's ``\\s`` matches.
_WHITE_SPACE = " \t\n\x0b\f\r"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rtrim_ws(col: Column | str) -> Column:
    """drop trailing whitespace (Java ``\\s``); one pass from the end, so a
    long run of blanks inside a text costs nothing extra."""
    return F.rtrim(_c(col), F.lit(_WHITE_SPACE))


def java_split(col: Column | str) -> Column:
    """``String.split("\\\\s+")`` with Java's rules.

    Leading whitespace yields an empty first token, trailing empties are
    dropped, ``""`` yields ``[""]`` and an all-blank line yields ``[]``.
    ``F.split`` alone would keep a trailing ``""``; trimming the tail first
    and special-casing blank lines gives the Java result.
    """
    c = _c(col)
    trimmed = rtrim_ws(c)
    return (F.when((F.length(c) > 0) & (trimmed == ""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, r"\s+")))


def python_split(col: Column | str) -> Column:
    """Python ``str.split()`` (no empty tokens at either end)."""
    return F.filter(F.split(F.trim(_c(col), ), r"\s+"), lambda t: t != "")


def split_nonempty(col: Column | str) -> Column:
    """Whitespace tokens with empties removed (basket items, N1)."""
    return F.filter(F.split(_c(col), r"\s+"), lambda t: t != "")


def letters_only(col: Column | str) -> Column:
    """remove every character that is not an ASCII letter."""
    return F.regexp_replace(_c(col), "[^A-Za-z]", "")


def first_letter(col: Column | str) -> Column:
    """F7 after F6: lower-cased first ASCII letter, or ``""``."""
    return F.lower(F.substring(letters_only(col), 1, 1))
