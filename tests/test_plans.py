"""Plan guards: properties of the physical plans the catalogue relies on."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"


def plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SMOKE).explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["word_count", "first_letter_count", "distinct_count_per_key",
                                  "pair_rules", "triple_rules", "friends_symmetric",
                                  "cf_user_user", "cf_item_item", "cms_estimate", "cms_error",
                                  "positional_join", "kmeans_assign_l2"])
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_text_scans_are_pruned(spark):
    for name in ("word_count", "first_letter_count"):
        text = plan(spark, name)
        assert "ReadSchema: struct<text:string>" in text
        assert text.count("Exchange (") == 1          # one partially aggregated shuffle


def test_distinct_per_key_is_two_level(spark):
    text = plan(spark, "distinct_count_per_key")
    assert text.count("HashAggregate (") == 4 and text.count("Exchange (") == 2


def test_friend_ranking_uses_partial_top_k(spark):
    assert "WindowGroupLimit" in plan(spark, "friends_symmetric")


def test_sketch_probe_broadcasts_bounded_sketch(spark):
    assert "BroadcastHashJoin" in plan(spark, "cms_estimate")
