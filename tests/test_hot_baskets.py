import random
from collections import Counter
from itertools import combinations

import pytest
from conftest import rows
from lodestar.operators import baskets as B
from lodestar.operators import text as T


def baskets(spark, seed=3):
    rng = random.Random(seed)
    data = [(0, f"i{n:04d}") for n in range(150)]
    data += [(b, f"i{n:04d}") for b in range(1, 40) for n in rng.sample(range(150), rng.randint(1, 25))]
    return spark.createDataFrame(data, "basket int, item string")


def test_cells_give_the_same_pairs_once(spark, monkeypatch):
    items = baskets(spark)
    want = rows(B._basket_pairs(items, ["basket"]))
    assert len(want) == len(set(want))
    for block in (8, 149):
        assert rows(B._basket_pairs(items, ["basket"], block)) == want
    frequent = rows(B.triple_support(items, ["basket"], 4))
    monkeypatch.setattr(B, "BLOCK_ITEMS", 16)
    assert rows(B.triple_support(items, ["basket"], 4)) == frequent != []


def test_a_huge_basket_is_made_by_many_tasks(spark):
    """One basket of 6,000 items: no cell has more than a few blocks' pairs."""
    items = spark.range(6000).selectExpr("id div 1000000 as basket", "cast(id as string) as item")
    pairs = B._basket_pairs(items, ["basket"], 500)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "_i" in plan and "_j" in plan
    by_task = pairs.groupBy(B.F.spark_partition_id().alias("t")).count().collect()
    assert sum(r["count"] for r in by_task) == 6000 * 5999 // 2
    assert max(r["count"] for r in by_task) < 0.5 * 6000 * 5999 // 2


def test_sketches_merge_and_stay_near(spark):
    df = spark.range(60_000).selectExpr("cast(if(id % 3 = 0, 0, id % 50) as string) as key", "id % 20011 as v")
    parts = [T.distinct_sketch(df.filter(f"id % 4 = {p}"), "key", "v") for p in range(4)]
    got = {r["key"]: r.n for r in T.sketch_estimate(T.merge_sketches(*parts)).collect()}
    want = {r["key"]: r.n for r in T.distinct_count_per_key(df, "key", "v").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - n) <= T.sketch_error() * n for k, n in want.items())
    again = {r["key"]: r.n for r in T.sketch_estimate(T.merge_sketches(*parts, parts[0])).collect()}
    assert again == got  # what is merged twice counts once


def test_the_bitmap_loses_no_frequent_pair(spark):
    items = baskets(spark)
    held = {}
    for basket, item in rows(items):
        held.setdefault(basket, []).append(item)
    counts = Counter(p for members in held.values() for p in combinations(sorted(members), 2))
    for support in (2, 4, 1000):
        want = sorted((a, b, n) for (a, b), n in counts.items() if n >= support)
        for buckets in (64, 4096, 1 << 22):
            assert rows(B.pair_support(items, ["basket"], support, buckets=buckets)) == want


def test_the_bitmap_drops_pairs_before_they_are_counted(spark):
    """Most pairs of many small baskets occur once: few pass, and the pairs counted by
    name are those behind the broadcast bitmap."""
    items = spark.range(60_000).selectExpr("id div 6 as basket", "xxhash64(id) % 900 as item").distinct()
    pairs = B._basket_pairs(items, ["basket"])
    bitmap = B.pair_bitmap(pairs, 12, 1 << 16)
    kept = B._in_bitmap(pairs, bitmap, 1 << 16)
    assert kept.columns == pairs.columns and kept.count() < 0.05 * pairs.count()
    plan = B.pair_support(items, ["basket"], 2, buckets=64)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bucket_numbers_are_checked_and_empty_tables_give_none(spark):
    items = baskets(spark)
    for bad in (1, 100):
        with pytest.raises(ValueError):
            B.pair_support(items, ["basket"], 2, buckets=bad)
    assert B.pair_support(items.limit(0), ["basket"], 2, buckets=64).count() == 0
