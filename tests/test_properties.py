"""Property tests: Spark operators against small brute-force models."""

import itertools
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from lodestar.functions.text import java_split
from lodestar.operators import baskets as B
from lodestar.operators import sketch as C
from lodestar.operators.sequence import with_global_index, with_global_next

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
JAVA_WS = re.compile(r"[ \t\n\x0b\f\r]+")


def java_split_model(s: str) -> list[str]:
    """``String.split("\\\\s+")``: no match -> [s]; else split, drop trailing empties."""
    if not JAVA_WS.search(s):
        return [s]
    parts = JAVA_WS.split(s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab \t\n\x0b", max_size=10), min_size=1, max_size=20))
def test_java_split_matches_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r["i"]: list(r["t"]) for r in df.select("i", java_split("value").alias("t")).collect()}
    assert got == {i: java_split_model(t) for i, t in enumerate(texts)}


@SETTINGS
@given(st.lists(st.lists(st.sampled_from("abcdef"), max_size=6), min_size=1, max_size=25),
       st.integers(min_value=1, max_value=4))
def test_apriori_matches_brute_force(spark, baskets, support):
    df = spark.createDataFrame([(i, " ".join(b)) for i, b in enumerate(baskets)],
                               "basket long, text string")
    items = B.basket_items(df, ["basket"], "text")
    sets = [sorted(set(b)) for b in baskets]

    def brute(k):
        c = Counter(t for s in sets for t in itertools.combinations(s, k))
        return sorted((*t, n) for t, n in c.items() if n >= support)

    assert rows(B.item_support(items, support)) == brute(1)
    assert rows(B.pair_support(items, ["basket"], support)) == brute(2)
    assert rows(B.triple_support(items, ["basket"], support)) == brute(3)


@SETTINGS
@given(st.lists(st.integers(min_value=-10**6, max_value=10**6), min_size=1, max_size=60,
                unique=True),
       st.integers(min_value=1, max_value=5))
def test_global_index_and_next(spark, keys, parts):
    df = spark.createDataFrame([(k, k * 3) for k in keys], "k long, v long").repartition(3)
    order = sorted(keys)
    assert rows(with_global_index(df, ["k"], n_parts=parts), "k", "idx") == [
        (k, i) for i, k in enumerate(order)]
    nxt = dict(rows(with_global_next(df, ["k"], ["v"], n_parts=parts), "k", "next_v"))
    assert nxt == {k: (order[i + 1] * 3 if i + 1 < len(order) else None)
                   for i, k in enumerate(order)}


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=5000), min_size=1, max_size=200),
       st.integers(min_value=3, max_value=50))
def test_sketch_never_underestimates(spark, ids, buckets):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    err = rows(C.cms_error(df, "id", n_buckets=buckets), "id", "true_n", "estimate")
    truth = Counter(ids)
    assert [(i, n) for i, n, _ in err] == sorted(truth.items())
    assert all(e >= n for _, n, e in err)


def _friends_model(edges, top_n=10):
    import itertools
    friends = {}
    for a, b in edges:
        friends.setdefault(a, set()).add(b)
        friends.setdefault(b, set()).add(a)
    cnt = Counter()
    for fs in friends.values():
        for u, v in itertools.permutations(sorted(fs), 2):
            if v not in friends[u]:
                cnt[(u, v)] += 1
    out = []
    for u in sorted(friends):
        ranked = sorted(((v, n) for (x, v), n in cnt.items() if x == u), key=lambda t: (-t[1], t[0]))
        out += [(u, v, n, r + 1) for r, (v, n) in enumerate(ranked[:top_n])] or [(u, None, None, None)]
    return sorted(out, key=lambda t: [(x is not None, x or 0) for x in t])


@SETTINGS
@given(st.sets(st.tuples(st.integers(0, 12), st.integers(0, 12)).filter(lambda e: e[0] != e[1]),
               min_size=1, max_size=40),
       st.integers(min_value=1, max_value=4))
def test_friends_match_brute_force(spark, edges, top_n):
    from lodestar.operators import graph as G
    sym = sorted(set(edges) | {(b, a) for a, b in edges})
    adj = spark.createDataFrame(sym, "src long, dst long")
    got = rows(G.recommend_friends(adj, top_n, "symmetric"), "user_id", "candidate", "n", "rank")
    assert got == _friends_model(edges, top_n)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9)).filter(lambda e: e[0] != e[1]),
               min_size=2, max_size=30),
       st.sampled_from(["edges", "scores", "salted"]))
def test_power_iteration_matches_numpy(spark, edges, mode):
    import numpy as np

    from lodestar.operators import graph as G
    nodes = sorted({n for e in edges for n in e})
    idx = {n: i for i, n in enumerate(nodes)}
    m = np.zeros((len(nodes), len(nodes)))
    outdeg = Counter(a for a, _ in edges)
    for a, b in edges:
        m[idx[b], idx[a]] = 1.0 / outdeg[a]
    r = np.ones(len(nodes)) / len(nodes)
    for _ in range(4):
        r = (1 - 0.8) / len(nodes) + 0.8 * m @ r
    old = (G.MAX_BROADCAST_EDGES, G.MAX_BROADCAST_NODES)
    G.MAX_BROADCAST_EDGES = 10**6 if mode == "edges" else 0
    G.MAX_BROADCAST_NODES = 10**6 if mode == "scores" else 0
    try:
        df = spark.createDataFrame(sorted(edges), "src long, dst long")
        got = dict(rows(G.pagerank_power(df, rounds=4, beta=0.8, checkpoint_every=2), "page", "rank"))
    finally:
        G.MAX_BROADCAST_EDGES, G.MAX_BROADCAST_NODES = old
    assert set(got) == set(nodes)
    assert all(abs(got[n] - r[idx[n]]) < 1e-12 for n in nodes)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 7), st.integers(0, 9)), min_size=4, max_size=40),
       st.integers(min_value=0, max_value=10))
def test_cf_matches_dense_formula(spark, cells, hide_below):
    import numpy as np

    from lodestar.operators import recommend as R
    target = 0
    rm = {(u, i) for u, i in cells if not (u == target and i < hide_below)}
    users = sorted({u for u, _ in rm})
    items = sorted({i for _, i in rm})
    if target not in users:
        return
    ui, ii = {u: k for k, u in enumerate(users)}, {i: k for k, i in enumerate(items)}
    m = np.zeros((len(users), len(items)))
    for u, i in rm:
        m[ui[u], ii[i]] = 1
    p, q = m.sum(1), m.sum(0)
    su = (np.diag(p ** -0.5) @ m @ m.T @ np.diag(p ** -0.5) @ m)[ui[target]]
    si = (m @ np.diag(q ** -0.5) @ m.T @ m @ np.diag(q ** -0.5))[ui[target]]
    r = spark.createDataFrame(sorted(cells), "user long, item long")
    for fn, dense in ((R.cf_user_user, su), (R.cf_item_item, si)):
        # the bound both hides the target's block (before degrees) and slices the ranking
        ranked = fn(r, target, hide_below, 20, mask=True)
        got = {i: s for i, s, _ in rows(ranked, "item", "score", "rank")}
        want = {i: dense[ii[i]] for i in items if i < hide_below and dense[ii[i]] > 0}
        assert set(got) == set(want)
        assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.integers(-3, 3), min_size=3, max_size=3),
                          st.sampled_from([-1, 1])), min_size=1, max_size=15),
       st.lists(st.integers(-2, 2), min_size=3, max_size=3), st.integers(-1, 1))
def test_svm_round_matches_numpy(spark, data, w, b):
    import numpy as np

    from lodestar.operators import linear as L
    x = np.array([f for f, _ in data], dtype=float)
    y = np.array([lab for _, lab in data], dtype=float)
    wv = np.array(w, dtype=float) / 4
    margin = y * (x @ wv + b)
    viol = margin < 1
    cost = 0.5 * wv @ wv + 100 * np.maximum(0, 1 - margin).sum()
    dw = wv + 100 * (-(y[viol, None] * x[viol])).sum(0)
    db = 100 * (-y[viol]).sum()
    df = spark.createDataFrame([(i, [float(v) for v in f], lab) for i, (f, lab) in enumerate(data)],
                               "row_id long, features array<double>, y int")
    got = L.svm_cost_gradient(df, list(wv), float(b), 100.0)
    assert got[0] == pytest.approx(cost) and got[1] == pytest.approx(list(dw)) and got[2] == db


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5)), min_size=3, max_size=30),
       st.sampled_from(["l2", "l1"]))
def test_kmeans_step_matches_numpy(spark, pts, dist):
    import numpy as np

    from lodestar.operators import cluster as K
    x = np.array(pts, dtype=float)
    cent = x[:3].copy()
    diff = x[:, None, :] - cent[None]
    d = (diff ** 2).sum(2) if dist == "l2" else np.abs(diff).sum(2)
    lab = d.argmin(1)
    loss = d[np.arange(len(x)), lab].sum()
    new = [x[lab == k].mean(0).tolist() if (lab == k).any() else cent[k].tolist() for k in range(3)]
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)],
                               "vec_id long, features array<double>")
    got_new, got_loss = K.kmeans_step(df, cent.tolist(), dist)
    assert got_loss == pytest.approx(loss)
    assert np.allclose(np.array(got_new), np.array(new))
