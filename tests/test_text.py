import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from lodestar.functions.text import java_split, python_split
from lodestar.operators.text import (distinct_count_per_key, first_letter_count, split_records,
                                     word_count)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_java_split_rules(spark):
    df = lines(spark, " a b ", "", "   ", "a\tb")
    got = [r[0] for r in df.select(java_split("value")).collect()]
    assert got == [["", "a", "b"], [""], [], ["a", "b"]]


def test_python_split(spark):
    got = lines(spark, "  x  y z ").select(python_split("value")).first()[0]
    assert got == ["x", "y", "z"]


def test_word_count_keeps_empty_token(spark):
    df = lines(spark, " a b ", "", "   ", "a\tb")
    assert rows(word_count(df)) == [("", 2), ("a", 2), ("b", 2)]


def test_word_count_stub_case(spark):
    assert rows(word_count(lines(spark, "cat cat dog"))) == [("cat", 2), ("dog", 1)]


def test_first_letter(spark):
    df = lines(spark, "The 7 quick-fox 'Tis 99% x9")
    assert rows(first_letter_count(df)) == [("q", 1), ("t", 2), ("x", 1)]


def test_distinct_records(spark):
    df = lines(spark, "h1 [t] GET /a", "h1 [t] GET /b", "h1 x GET /a", "h2 [t] GET /a",
               "k - a bc", "k - ab c", "short line x")
    recs = split_records(df)
    assert rows(distinct_count_per_key(recs)) == [("h1", 2), ("h2", 1), ("k", 1)]


def test_distinct_records_strict_raises(spark):
    df = lines(spark, "only three fields")
    with pytest.raises(PySparkException):
        split_records(df, strict=True).collect()


def test_distinct_count_with_expression(spark):
    df = spark.createDataFrame([(1, "a", "b"), (1, "ab", ""), (2, "x", "y")], "k int, a string, b string")
    out = distinct_count_per_key(df, "k", F.concat("a", "b"))
    assert rows(out) == [(1, 1), (2, 1)]


def test_first_letter_matches_token_definition(spark):
    from lodestar.functions.text import first_letter
    texts = ["  7x  --ab\tc9 Z", "", "   ", "é ü9 Ña q", "a\nb\r\nc", "(1)(2) x-y", "\x0bv w"]
    df = lines(spark, *texts)
    brute = (df.select(java_split("value").alias("t")).selectExpr("explode(t) AS token")
             .select(first_letter("token").alias("letter")).filter("letter <> ''")
             .groupBy("letter").count())
    assert rows(first_letter_count(df)) == rows(brute)


def test_word_count_can_drop_empty_token(spark):
    df = lines(spark, " a b ", "   ")
    assert rows(word_count(df, keep_empty=False)) == [("a", 1), ("b", 1)]
