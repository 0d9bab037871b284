import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import posting_lists as L
from lodestar.llm.queries import QUERIES


def brute(rows, asked, k=10):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v
                   and np.isfinite(v).all() and any(v)})
    out = {}
    for i, v in good:
        if asked(i):
            d = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in good if j != i)
            out[i] = [(j, round(s, 9)) for s, j in d[:k]]
    return out


def run(df, query, **more):
    out = {}
    for r in sorted(L.nearest(df, query, **more).collect(), key=lambda r: (r.query_id, r.rank)):
        got = out.setdefault(r.query_id, [])
        got.append((r.vec_id, round(r.score, 9)))
        assert r.rank == len(got)
    return out


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(rng.integers(-2, 3, 4))]) for i in range(300)]
    hot = [1.0, 1.0, 0.0, 0.0]
    rows += [(1000 + i, hot) for i in range(150)]
    rows += [(2000, None), (2005, [0.0] * 4), (2010, [1.0, None, 0.0, 0.0]), (2015, [float("nan"), 1.0, 1.0, 1.0]),
             (2020, [float("inf"), 1.0, 1.0, 1.0]), (None, hot), (2025, [1.0, 2.0]), (1000, hot)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    want = brute([r for r in rows if r[0] != 2025], lambda i: i % 5 == 0)
    assert run(df, F.col("id") % 5 == 0, list_rows=64, query_ratio=1e9) == want
    assert L.nearest(df.filter("false"), F.col("id") % 5 == 0).count() == 0
    assert run(df.filter("vec_id in (0, 5, 2005)"), F.col("id") % 5 == 0) == brute(rows[0:6:5], lambda i: True)


def test_blocks_of_a_long_list(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert run(df, F.col("id") % 40 == 0, list_rows=200, query_ratio=1e9) == brute(rows, lambda i: i % 40 == 0)


def test_graph_and_balance():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(3000, 8)), rng.normal(5, .1, size=(1000, 8))])
    c = L.bisect(x, 100)
    assert len(c) == 100
    g = L.CentroidGraph(c)
    q = rng.normal(size=(200, 8))
    ids, d = g.search(q, 32)
    full = ((q[:, None] - c) ** 2).sum(2)
    assert np.mean([len(set(a) & set(np.argsort(f)[:10])) for a, f in zip(ids[:, :10], full, strict=True)]) > 9.5
    assert np.allclose(d, np.take_along_axis(full, ids, 1))


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_recall(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    got = {}
    for r in QUERIES["op9_posting_lists"](spark, d).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert sorted(got) == sorted(ids[ids % 100 == 0])
    hits = 0
    for q, found in got.items():
        dist = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        dist[ids == q] = np.inf
        hits += len(set(ids[np.argsort(dist)[:10]]) & set(found))
        assert len(found) == 10 and all(abs(dist[ids == v][0] - s) < 1e-12 for v, s in found.items())
    assert hits >= 9 * len(got)
