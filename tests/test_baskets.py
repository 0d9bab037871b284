import pytest

from conftest import rows
from lodestar.operators import baskets as B

BASKETS = [(1, "a b c a"), (2, "a b d"), (3, "a c"), (4, "b c"), (5, "a b c")]


@pytest.fixture()
def items(spark):
    df = spark.createDataFrame(BASKETS, "basket long, text string")
    return B.basket_items(df, ["basket"], "text")


def test_item_support(items):
    assert rows(B.item_support(items, 2)) == [("a", 4), ("b", 4), ("c", 4)]


def test_pair_and_triple_support(items):
    assert rows(B.pair_support(items, ["basket"], 2)) == [("a", "b", 3), ("a", "c", 3),
                                                           ("b", "c", 3)]
    assert rows(B.triple_support(items, ["basket"], 2)) == [("a", "b", "c", 2)]


def test_threshold_is_inclusive(items):
    assert rows(B.triple_support(items, ["basket"], 3)) == []
    assert len(rows(B.pair_support(items, ["basket"], 3))) == 3


def test_rules(items):
    fi = B.item_support(items, 2)
    fp = B.pair_support(items, ["basket"], 2, fi)
    pr = rows(B.pair_rules(fp, fi), "rule", "confidence")
    assert len(pr) == 6 and all(c == 0.75 for _, c in pr)
    assert ("a->b", 0.75) in pr and ("b->a", 0.75) in pr
    tr = rows(B.triple_rules(B.triple_support(items, ["basket"], 2, fi, fp), fp), "rule",
              "confidence")
    assert [r for r, _ in tr] == ["a,b->c", "a,c->b", "b,c->a"]
    assert all(abs(c - 2 / 3) < 1e-15 for _, c in tr)
    f32 = B.rules_as_float32(B.pair_rules(fp, fi)).schema["confidence"].dataType.simpleString()
    assert f32 == "float"


def test_support_monotone_property(items):
    fi = dict(rows(B.item_support(items, 1)))
    for a, b, n in rows(B.pair_support(items, ["basket"], 1)):
        assert n <= min(fi[a], fi[b])


def test_support_threshold_formula():
    assert [B.support_threshold(n) for n in (87, 536, 5012)] == [17, 100, 933]


def test_fpgrowth_agrees_with_apriori(spark):
    df = spark.createDataFrame(BASKETS, "basket long, text string")
    arrays = B.basket_arrays(df, ["basket"], "text")
    got = sorted((tuple(r["items"]), r["n"]) for r in B.frequent_itemsets(arrays, 2, 5).collect())
    assert got == [(("a",), 4), (("a", "b"), 3), (("a", "b", "c"), 2), (("a", "c"), 3),
                   (("b",), 4), (("b", "c"), 3), (("c",), 4)]


def test_tasks_follow_the_pairs(spark, monkeypatch):
    """Where pairs are many they are made and counted by as many tasks as they take."""
    from collections import Counter
    from itertools import combinations

    baskets = {b: sorted({(b * 7 + i * i) % 40 for i in range(9)}) for b in range(60)}
    items = spark.createDataFrame([(b, i) for b, own in baskets.items() for i in own], "b long, item long")
    n = Counter(p for own in baskets.values() for p in combinations(own, 2))
    monkeypatch.setattr(B, "TASK_PAIRS", 40)
    tasks = -(-sum(n.values()) // 40)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = B.pair_support(items, ["b"], 2, buckets=64)
    assert {(r.item_a, r.item_b): r.n for r in got.collect()} == {p: k for p, k in n.items() if k > 1}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression [item_a" in plan and f", {tasks}" in plan
