import pytest

from conftest import rows
from lodestar.operators import graph as G

FRIENDS = {1: [2, 3], 2: [1, 3, 4], 3: [1, 2, 4], 4: [2, 3, 5], 5: [4], 6: []}
EDGES = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c"), ("a", "b")]


@pytest.fixture()
def adj(spark):
    data = [(u, f, i) for u, fs in FRIENDS.items() for i, f in enumerate(fs)]
    return spark.createDataFrame(data, "src long, dst long, pos int")


@pytest.fixture()
def users(spark):
    return spark.createDataFrame([(u,) for u in FRIENDS], "user long")


@pytest.fixture()
def edges(spark):
    return spark.createDataFrame(EDGES, "src string, dst string")


def test_friends_symmetric(adj, users):
    got = rows(G.recommend_friends(adj, 10, "symmetric", users), "user_id", "candidate", "n",
               "rank")
    assert got == [(1, 4, 2, 1), (2, 5, 1, 1), (3, 5, 1, 1), (4, 1, 2, 1), (5, 2, 1, 1),
                   (5, 3, 1, 2), (6, None, None, None)]


def test_friends_list_order_text(adj, users):
    got = rows(G.recommend_friends_text(adj, 10, "list_order", users))
    assert got == [(1, "4"), (2, "5"), (3, "5"), (4, ""), (5, ""), (6, "")]


def test_friends_top_n_cut(adj, users):
    got = rows(G.recommend_friends(adj, 1, "symmetric", users), "user_id", "candidate")
    assert (5, 2) in got and (5, 3) not in got


def _ranks(df):
    return {p: round(r, 10) for p, r in rows(df, "page", "rank")}


def test_pagerank_edge_rounds(edges):
    r1 = _ranks(G.pagerank_edge(edges, rounds=1))
    assert r1 == {"a": 0.25, "b": 0.14375, "c": 0.56875}
    r2 = _ranks(G.pagerank_edge(edges, rounds=2))
    assert r2 == {"a": 0.5209375, "b": 0.14375, "c": 0.2659375}


def test_pagerank_power_round(edges):
    assert _ranks(G.pagerank_power(edges, rounds=1, beta=0.8)) == {
        "a": 0.25, "b": 0.15, "c": 0.55, "d": 0.05}


def test_pagerank_power_keeps_mass_without_dead_ends(edges):
    total = sum(_ranks(G.pagerank_power(edges, rounds=7, beta=0.8, checkpoint_every=3)).values())
    assert abs(total - 1.0) < 1e-9


def test_hits_one_round(edges):
    got = {p: (round(h, 10), round(a, 10)) for p, h, a in rows(G.hits(edges, rounds=1))}
    assert got == {"a": (1.0, round(1 / 3, 10)), "b": (0.75, round(1 / 3, 10)),
                   "c": (0.25, 1.0), "d": (0.75, 0.0)}


def test_rank_extremes_order(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(10)], "page long, rank double")
    got = rows(G.rank_extremes(df, "rank", "page", 3))
    # low -> high; ties ascend by id, so the top list prefers larger ids
    assert got == [("bottom", 1, 0), ("bottom", 2, 4), ("bottom", 3, 8),
                   ("top", 1, 6), ("top", 2, 3), ("top", 3, 7)]


def test_salted_path_matches_broadcast_path(spark, monkeypatch):
    hub = [(0, d) for d in range(1, 300)]
    rest = [(s, (s * 7) % 300) for s in range(1, 300) if (s * 7) % 300 != s]
    edges = spark.createDataFrame(hub + rest, "src long, dst long")
    want = {p: round(r, 12) for p, r in rows(G.pagerank_power(edges, rounds=3), "page", "rank")}
    want_h = rows(G.hits(edges, rounds=2))
    monkeypatch.setattr(G, "MAX_BROADCAST_EDGES", 0)
    for max_nodes in (10_000, 0):           # score broadcast, then salted
        monkeypatch.setattr(G, "MAX_BROADCAST_NODES", max_nodes)
        got = {p: round(r, 12) for p, r in rows(G.pagerank_power(edges, rounds=3), "page", "rank")}
        assert got == want
        got_h = rows(G.hits(edges, rounds=2))
        assert [(p, round(h, 12), round(a, 12)) for p, h, a in got_h] == \
            [(p, round(h, 12), round(a, 12)) for p, h, a in want_h]


def test_friends_with_a_hub_match_brute_force(spark):
    import itertools
    from collections import Counter
    edges = {(0, v) for v in range(1, 60)} | {(v, (v * 7) % 60) for v in range(1, 60) if (v * 7) % 60 != v}
    sym = sorted(edges | {(b, a) for a, b in edges})
    adj = spark.createDataFrame(sym, "src long, dst long")
    friends = {}
    for a, b in sym:
        friends.setdefault(a, set()).add(b)
    cnt = Counter()
    for m, fs in friends.items():
        for u, v in itertools.permutations(sorted(fs), 2):
            if v not in friends[u]:
                cnt[(u, v)] += 1
    want = []
    for u in sorted(friends):
        ranked = sorted(((v, n) for (x, v), n in cnt.items() if x == u), key=lambda t: (-t[1], t[0]))
        want += [(u, v, n, r + 1) for r, (v, n) in enumerate(ranked[:10])] or [(u, None, None, None)]
    got = rows(G.recommend_friends(adj, 10, "symmetric"), "user_id", "candidate", "n", "rank")
    assert got == sorted(want, key=lambda t: [(v is not None, v or 0) for v in t])


def test_list_order_follows_list_positions(spark):
    # one adjacency row per user; the lists are deliberately not sorted by id
    lists = {1: [3, 2], 2: [1], 3: [1], 4: [3, 2]}
    adj = spark.createDataFrame([(u, f, i) for u, fs in lists.items() for i, f in enumerate(fs)],
                                "src long, dst long, pos int")
    got = rows(G.recommend_friends(adj, 10, "list_order"), "user_id", "candidate", "n")
    # rows 1 and 4 emit 3 -> 2 (3 before 2), never 2 -> 3; 2 and 3 have a single friend
    assert got == [(1, None, None), (2, None, None), (3, 2, 2), (4, None, None)]


@pytest.mark.parametrize("mode", ["symmetric", "list_order", "placed"])
def test_friends_over_many_blocks_and_pieces(spark, monkeypatch, mode):
    """Lists in pieces and users over many blocks, against a count of all pairs: a hub,
    repeated friends, ties of places, nulls."""
    import random
    from collections import Counter

    monkeypatch.setattr(G, "LIST_PIECE", 4)
    monkeypatch.setattr(G, "BLOCK_PAIRS", 60)
    rng = random.Random(3)
    data = {(0, v, v % 7) for v in range(1, 50)} | {(rng.randrange(50), rng.randrange(50), rng.randrange(5)) for _ in range(160)}
    data |= {(None, 3, 1), (None, 4, 2), (5, 8, None)} | ({(5, None, 1), (6, None, 2)} if mode == "placed" else {(5, None, 1)})
    adj = spark.createDataFrame(list(data), "src long, dst long, pos int")
    adj = adj if mode == "placed" else adj.drop("pos")
    lists, friends = {}, {(s, d) for s, d, _ in data}
    for s, d, p in data:
        if s is not None:
            lists.setdefault(s, []).append((d, p if mode == "placed" else d))
    n = Counter((a, b) for own in lists.values() for a, pa_ in own for b, pb in own
                if pa_ is not None and pb is not None and (a != b if mode == "symmetric" else pa_ < pb)
                and (None in (a, b) or (a, b) not in friends))
    got = G.friend_candidates(adj, 1000, "symmetric" if mode == "symmetric" else "list_order").collect()
    assert {(r.user_id, r.candidate): r.n for r in got} == dict(n)
    top = G.friend_candidates(adj, 2, "symmetric" if mode == "symmetric" else "list_order").collect()
    assert sorted(map(str, top)) == sorted(str(r) for r in got if r["rank"] <= 2)


def test_rounds_shuffle_sums_not_partial_sums(spark, monkeypatch):
    """With broadcast scores, edges lie by destination: a round's only exchange carries
    one sum a page, however many tasks hold its edges."""
    monkeypatch.setattr(G, "MAX_BROADCAST_EDGES", 0)
    edges = spark.createDataFrame([(s, d) for s in range(60) for d in range(5)], "src long, dst long")
    links = G._links(edges, weighted=False)
    flow = G._Flow(links, "src", "dst", links.count(), G._nodes(links))
    assert flow.mode == "scores"
    scores = spark.createDataFrame([(s, 1.0) for s in range(60)], "page long, s double")
    sent = flow.spread(scores, "s")
    sent.collect()
    plan = sent._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "Exchange hashpartitioning" not in plan
    assert sorted(map(tuple, sent.groupBy("page").agg(G.F.sum("c")).collect())) == [(d, 60.0) for d in range(5)]
    flow.release()
    links.unpersist()
