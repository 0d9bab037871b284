import random

import pytest
from conftest import rows
from lodestar.operators import graph as G
from lodestar.operators import packed as P

SIZES = [{}, {"block_pages": 8, "group_edges": 20}, {"block_pages": 1, "group_edges": 1}]


def graph(spark, seed=5):
    """A hub that holds a third of the edges, dead ends, a page nobody links to, loops, repeats."""
    rng = random.Random(seed)
    edges = [(0, d) for d in range(1, 60)] + [(200, 0), (5, 5), (5, 5)]
    edges += [(rng.randrange(50), rng.randrange(70)) for _ in range(120)]
    return spark.createDataFrame(edges, "src long, dst long")


def near(got, want):
    assert [r[0] for r in got] == [r[0] for r in want]
    for g, w in zip(got, want):
        assert g[1:] == pytest.approx(w[1:], rel=1e-9, abs=1e-15)


@pytest.mark.parametrize("sizes", SIZES[:2])
def test_packed_ranks_equal_the_row_form(spark, sizes):
    edges = graph(spark).persist()
    near(rows(P.pagerank_power(edges, rounds=5, checkpoint_every=2, **sizes)), rows(G.pagerank_power(edges, rounds=5)))
    near(rows(P.pagerank_edge(edges, rounds=4, checkpoint_every=3, **sizes)), rows(G.pagerank_edge(edges, rounds=4)))
    near(rows(P.hits(edges, rounds=4, checkpoint_every=2, **sizes)), rows(G.hits(edges, rounds=4)))


def test_ranks_against_a_plain_loop(spark):
    edges = graph(spark)
    pairs = sorted(set(rows(edges)))
    out = {}
    for s, d in pairs:
        out.setdefault(s, []).append(d)
    pages = sorted({p for e in pairs for p in e})
    r = {p: 1 / len(pages) for p in pages}
    for _ in range(6):
        nxt = {p: 0.2 / len(pages) for p in pages}
        for s, ds in out.items():
            for d in ds:
                nxt[d] += 0.8 * r[s] / len(ds)
        r = nxt
    for sizes in SIZES:
        near(rows(P.pagerank_power(edges, rounds=6, **sizes)), sorted(r.items()))


def test_a_hub_is_spread_over_groups(spark):
    """One page with all 4,000 edges: no group has more than a few times its bound."""
    edges = spark.range(1, 4001).selectExpr("0L as src", "id as dst")
    g = P.PackedGraph(edges, block_pages=512, group_edges=100)
    groups = g.forward[0].selectExpr("sb", "salt", "size(e) as n").groupBy("sb", "salt").sum("n").collect()
    assert sum(r[2] for r in groups) == 4000 and len(groups) >= 35 and max(r[2] for r in groups) < 200
    g.release()


def test_a_round_moves_no_edge(spark):
    edges = graph(spark)
    g = P.PackedGraph(edges, block_pages=8, group_edges=20)
    one = g.step(g.forward, g.start(g.forward, 1.0), lambda s, w: s)
    plan = one._jdf.queryExecution().executedPlan().toString()
    ours = plan.split("InMemoryRelation")[0]
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in ours and "NestedLoop" not in plan
    edge_side = plan[plan.index("FlatMapCoGroupsInArrow"):].split("InMemoryTableScan")[0]
    assert "Exchange" not in edge_side
    g.release()


def test_strings_nulls_and_no_edges(spark):
    named = spark.createDataFrame([("b", "a"), ("c", "a"), (None, "a"), ("a", None), ("b", "c")], "src string, dst string")
    clean = named.dropna()
    near(rows(P.pagerank_power(named, rounds=3)), rows(G.pagerank_power(clean, rounds=3)))
    for f, columns in ((P.pagerank_power, ["page", "rank"]), (P.pagerank_edge, ["page", "rank"]),
                       (P.hits, ["page", "hub", "authority"])):
        none = f(named.limit(0), rounds=2)
        assert none.columns == columns and none.count() == 0
