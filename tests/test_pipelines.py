"""End-to-end flows from the reference's text layouts to results."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestar.operators import baskets as B
from lodestar.operators import cluster as K
from lodestar.operators import graph as G
from lodestar.operators import linear as L
from lodestar.operators import recommend as R
from lodestar.operators import sketch as C
from lodestar.operators import text as T
from lodestar.operators.joins import positional_join
from lodestar.sources import sinks as IO
from lodestar.sources import text as TX


def write(path, text):
    path.write_text(text)
    return str(path)


def test_word_count_file_to_tsv(spark, tmp_path):
    src = write(tmp_path / "corpus.txt", "cat cat dog\n dog  emu\n")
    out = str(tmp_path / "out")
    IO.write_kv_text(T.word_count(TX.read_lines(spark, src)), "token", "n", out)
    assert rows(IO.read_kv_text(spark, out)) == [("", 1), ("cat", 2), ("dog", 2), ("emu", 1)]


def test_record_count_from_log_lines(spark, tmp_path):
    src = write(tmp_path / "log.txt", "h1 - GET /a 200\nh1 - GET /b 200\nh2 - GET /a 404\nbad line\n")
    recs = T.split_records(TX.read_lines(spark, src))
    assert rows(T.distinct_count_per_key(recs)) == [("h1", 2), ("h2", 1)]


def test_apriori_from_basket_lines(spark, tmp_path):
    src = write(tmp_path / "baskets.txt", "a b c a\na b d\na c\nb c\na b c\n")
    lines = TX.read_lines_indexed(spark, src, "basket")
    items = B.basket_items(lines, ["basket"], "value")
    fi = B.item_support(items, 2)
    fp = B.pair_support(items, ["basket"], 2, fi)
    ft = B.triple_support(items, ["basket"], 2, fi, fp)
    rules = rows(B.rules_as_float32(B.triple_rules(ft, fp)), "rule", "confidence")
    assert [r for r, _ in rules] == ["a,b->c", "a,c->b", "b,c->a"]
    assert all(c == pytest.approx(2 / 3, rel=1e-6) for _, c in rules)


def test_friends_from_adjacency_file(spark, tmp_path):
    src = write(tmp_path / "adj.txt", "1\t2,3\n2\t1,3,4\n3\t1,2,4\n4\t2,3,5\n5\t4\n6\n")
    adj_rows = TX.read_adjacency(spark, src)
    edges = TX.adjacency_edges(adj_rows)
    users = adj_rows.select("user")
    got = rows(G.recommend_friends_text(edges, 10, "list_order", users))
    assert got == [(1, "4"), (2, "5"), (3, "5"), (4, ""), (5, ""), (6, "")]


def test_kmeans_from_point_and_centroid_files(spark, tmp_path):
    pts = write(tmp_path / "points.txt", "0 0\n0 2\n10 0\n10 2\n")
    cen = write(tmp_path / "centroids.txt", "0\t0 0 \n1\t10 0 \nLoss\t99\n")
    points = TX.read_vectors(spark, pts)
    centers = [r["center"] for r in TX.read_centroids(spark, cen).orderBy("cluster").collect()]
    new, losses = K.kmeans_fit(points, centers, 2, "l2")
    assert losses == [8.0, 4.0] and new == [[0.0, 1.0], [10.0, 1.0]]


def test_pagerank_from_edge_files(spark, tmp_path):
    ws = write(tmp_path / "links.txt", "a b x\na c\nb\tc\nc a\nd c\na b\n")
    ranks = {p: round(r, 10) for p, r in rows(G.pagerank_edge(TX.read_edges_ws(spark, ws), 1),
                                               "page", "rank")}
    assert ranks == {"a": 0.25, "b": 0.14375, "c": 0.56875}
    tab = write(tmp_path / "edges.tsv", "1\t2\n1\t3\n2\t3\n3\t1\n4\t3\n1\t2\n")
    power = {p: round(r, 10) for p, r in rows(G.pagerank_power(TX.read_edges_tab(spark, tab), 1),
                                              "page", "rank")}
    assert power == {1: 0.25, 2: 0.15, 3: 0.55, 4: 0.05}


def test_sketch_error_from_stream_and_counts(spark, tmp_path):
    stream = write(tmp_path / "stream.txt", "0\n1\n0\n123457\n149\n")
    counts = write(tmp_path / "counts.txt", "0\t2\n1\t1\n123457\t1\n149\t1\n")
    ids = TX.read_lines(spark, stream).select(F.col("value").cast("long").alias("id"))
    sketch = C.cms_sketch(ids, "id")
    exact = TX.read_counts(spark, counts)
    est = C.cms_estimate(sketch, exact.select(F.col("event_id").alias("id")))
    got = rows(exact.join(est, exact.event_id == est.id), "event_id", "n", "estimate")
    assert got == [(0, 2, 3), (1, 1, 1), (149, 1, 1), (123457, 1, 3)]


def test_svm_from_feature_and_label_files(spark, tmp_path):
    feats = write(tmp_path / "rows.csv", "1,0\n0,1\n2,2\n")
    labels = write(tmp_path / "labels.txt", "1\n-1\n1\n")
    x = TX.read_int_rows(spark, feats).withColumnRenamed("row_id", "idx")
    y = TX.read_values(spark, labels, "int").withColumnRenamed("value", "y")
    data = positional_join(x, y).select(F.col("idx").alias("row_id"), "features", "y")
    cost, dw, db = L.svm_cost_gradient(data, [0.5, 0.0], 0.0, 100.0)
    assert cost == pytest.approx(150.125) and dw == pytest.approx([-99.5, 100.0]) and db == 0.0


def test_cf_from_dense_matrix_and_names(spark, tmp_path):
    mat = write(tmp_path / "matrix.txt", "1 1 0\n0 1 1\n1 1 1\n")
    names = write(tmp_path / "names.txt", '"A"\n"B"\n"C"\n')
    r = TX.read_dense_matrix(spark, mat).select(F.col("row_id").alias("user"),
                                                F.col("col_id").alias("item"))
    ranked = R.cf_user_user(r, 0, 3, 20, mask=False)
    got = rows(R.with_names(ranked, TX.read_values(spark, names)), "rank", "name")
    assert got == [(1, '"B"'), (2, '"A"'), (3, '"C"')]
