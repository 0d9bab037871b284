import pytest

from conftest import rows
from lodestar.operators.joins import positional_join, zip_text_files
from lodestar.operators.sequence import with_global_index, with_global_next
from lodestar.sources import sinks as IO
from lodestar.sources import text as TX


def write(path, text):
    path.write_text(text)
    return str(path)


def test_positional_join(spark, tmp_path):
    a = write(tmp_path / "a.txt", "x\ny\nz\n")
    b = write(tmp_path / "b.txt", "1\n-1\n1\n")
    assert rows(zip_text_files(spark, a, b)) == [(0, "x", "1"), (1, "y", "-1"), (2, "z", "1")]
    c = write(tmp_path / "c.txt", "1\n2\n")
    with pytest.raises(ValueError):
        zip_text_files(spark, a, c)


def test_positional_join_across_many_files(spark, tmp_path):
    df = spark.range(0, 500).repartition(7)
    p = str(tmp_path / "many")
    df.orderBy("id").selectExpr("CAST(id * 3 AS STRING) AS v").write.text(p)
    got = rows(TX.read_lines_indexed(spark, p))
    assert got == [(i, str(i * 3)) for i in range(500)]


def test_global_index_and_next_match_brute_force(spark):
    df = spark.range(0, 1000).selectExpr("(id * 7919) % 1000 AS k", "id AS v").repartition(5)
    idx = rows(with_global_index(df, ["k"], n_parts=4), "k", "idx")
    assert idx == [(k, k) for k in range(1000)]
    nxt = rows(with_global_next(df, ["k"], ["v"], n_parts=3), "k", "next_v")
    want = sorted(((k * 7919) % 1000, None) for k in range(1000))
    by_k = {(v * 7919) % 1000: v for v in range(1000)}
    want = [(k, by_k.get(k + 1)) for k in range(1000)]
    assert nxt == want


def test_read_adjacency_and_edges(spark, tmp_path):
    p = write(tmp_path / "adj.txt", "1\t2,3\n2\t1\n6\n")
    adj = TX.read_adjacency(spark, p)
    assert rows(adj) == [(1, [2, 3]), (2, [1]), (6, [])]
    assert rows(TX.adjacency_edges(adj)) == [(1, 0, 2), (1, 1, 3), (2, 0, 1)]


def test_read_edges(spark, tmp_path):
    p = write(tmp_path / "e.tsv", "1\t2\n3\t4\n")
    assert rows(TX.read_edges_tab(spark, p)) == [(1, 2), (3, 4)]
    q = write(tmp_path / "w.txt", "  a   b extra\nc\td\n")
    assert rows(TX.read_edges_ws(spark, q)) == [("a", "b"), ("c", "d")]


def test_read_centroids_skips_loss_row(spark, tmp_path):
    p = write(tmp_path / "c.txt", "0\t1.0 2.0 \n1\t3.0 4.0 \nLoss\t12.5\n")
    assert rows(TX.read_centroids(spark, p)) == [(0, [1.0, 2.0]), (1, [3.0, 4.0])]


def test_dense_matrix_and_values(spark, tmp_path):
    p = write(tmp_path / "m.txt", "0 1 0\n1 0 1\n")
    assert rows(TX.read_dense_matrix(spark, p)) == [(0, 1, 1), (1, 0, 1), (1, 2, 1)]
    v = write(tmp_path / "v.txt", "\"A\"  \n\"B\"\n")
    assert rows(TX.read_values(spark, v)) == [(0, '"A"'), (1, '"B"')]
    f = write(tmp_path / "f.txt", "1,2\n3,4\n")
    assert rows(TX.read_int_rows(spark, f)) == [(0, [1.0, 2.0]), (1, [3.0, 4.0])]


def test_bad_numbers_fail_or_null(spark, tmp_path):
    p = write(tmp_path / "bad.txt", "x\t1,2\n")
    with pytest.raises(Exception):
        TX.read_adjacency(spark, p).collect()
    assert rows(TX.read_adjacency(spark, p, permissive=True)) == [(None, [1, 2])]


def test_kv_text_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c,d", 5)], "k string, n long")
    p = str(tmp_path / "kv")
    IO.write_kv_text(df, "k", "n", p)
    assert rows(IO.read_kv_text(spark, p)) == [("a", 1), ("b", 2), ("c,d", 5)]
    first = spark.read.text(p).collect()
    assert sorted(r[0] for r in first) == ["a\t1", "b\t2", "c,d\t5"]


def test_list_and_vector_text(spark):
    df = spark.createDataFrame([([1, 2, 3], [1.5, 2.0]), ([], [])], "l array<long>, v array<double>")
    got = [(r[0], r[1]) for r in df.select(IO.list_value("l"), IO.vector_text("v")).collect()]
    assert got == [("1,2,3", "1.5 2.0 "), ("", " ")]


def test_positional_join_frames(spark):
    a = spark.createDataFrame([(0, "x")], "idx long, a string")
    b = spark.createDataFrame([(0, 1), (1, 2)], "idx long, b int")
    with pytest.raises(ValueError):
        positional_join(a, b)


def test_hot_keys_and_salts(spark):
    from pyspark.sql import functions as F
    from lodestar.plans.skew import hot_keys, salt_big, salt_small
    df = spark.createDataFrame([(0, i) for i in range(400)] + [(k, k) for k in range(1, 101)],
                               "k long, v long")
    hot = hot_keys(df, "k", parts=10)
    assert hot.keys == [0] and hot.buckets == [8]          # 400 rows / 50 per partition
    salts = {r[0] for r in df.filter("k = 0").select(salt_big("k", hot, "v")).collect()}
    assert salts == set(range(8))
    assert {r[0] for r in df.filter("k = 5").select(salt_big("k", hot, "v")).collect()} == {0}
    small = spark.createDataFrame([(0,), (5,)], "k long").select(
        "k", F.explode(salt_small("k", hot)).alias("s"))
    assert rows(small) == [(0, s) for s in range(8)] + [(5, 0)]


def test_single_file_sink(spark, tmp_path):
    import glob
    df = spark.range(0, 50).selectExpr("CAST(id AS STRING) AS k", "id AS n").repartition(5)
    p = str(tmp_path / "one")
    IO.write_kv_text(df, "k", "n", p, single_file=True)
    assert len(glob.glob(p + "/part-*")) == 1
    assert len(rows(IO.read_kv_text(spark, p))) == 50


def test_line_index_beyond_the_range_sample(spark, tmp_path):
    # enough lines that range bounds come from a sample (seeded per RDD), and
    # a summary branch that only needs the partition id: both must agree
    p = tmp_path / "many.txt"
    p.write_text("".join(f"{i}\n" for i in range(4000)))
    got = TX.read_lines_indexed(spark, str(p)).selectExpr("CAST(value AS BIGINT) = idx AS ok")
    assert got.filter("NOT ok").count() == 0
