from conftest import rows
from lodestar.operators import sketch as C
from lodestar.streaming.sketch_stream import cms_stream

EXPECTED = {0: [1561, 277, 394, 13, 246], 1: [1564, 294, 432, 74, 324],
            149: [2008, 2810, 6056, 9102, 1868], 123457: [1561, 277, 394, 13, 246],
            1000000: [8593, 6668, 9095, 2255, 8879]}


def test_cells(spark):
    df = spark.createDataFrame([(k,) for k in EXPECTED], "id long")
    got = {}
    for i, h, b in rows(C.cms_cells(df, "id", keep=["id"])):
        got.setdefault(i, []).append(b)
    assert got == EXPECTED


def test_estimate_collision_and_absent(spark):
    ev = spark.createDataFrame([(0,), (0,), (123457,), (1,)], "id long")
    sk = C.cms_sketch(ev, "id")
    probes = spark.createDataFrame([(0,), (1,), (42,)], "id long")
    assert rows(C.cms_estimate(sk, probes)) == [(0, 3), (1, 1), (42, 0)]
    empty = C.cms_sketch(ev.limit(0), "id")
    assert rows(C.cms_estimate(empty, probes)) == [(0, 0), (1, 0), (42, 0)]


def test_estimate_never_below_truth(spark):
    ev = spark.range(0, 3000).selectExpr("id % 700 AS id")
    err = C.cms_error(ev, "id", n_buckets=50)
    assert all(e >= t for _, t, e, _, _ in rows(err))


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "src"
    ev = spark.range(0, 5000).selectExpr("id % 313 AS user_id")
    ev.write.parquet(str(src / "a"))
    schema = ev.schema
    streamed = cms_stream(spark, str(src / "a"), "*.parquet", schema, "user_id", 100)
    assert rows(streamed) == rows(C.cms_sketch(ev, "user_id", 100))
    total = C.cms_total(streamed).first()[0]
    assert total == 5000


def test_text_stream_of_ids(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("0\n1 \n149\n0\n")
    (src / "b.txt").write_text("123457\n")
    sk = cms_stream(spark, str(src), "*.txt", None, "id", fmt="text")
    probes = spark.createDataFrame([(0,), (1,), (149,), (5,)], "id long")
    assert rows(C.cms_estimate(sk, probes)) == [(0, 3), (1, 1), (5, 0), (149, 1)]


def test_stream_resumes_from_checkpoint(spark, tmp_path):
    src, ck = tmp_path / "in", str(tmp_path / "ck")
    src.mkdir()
    (src / "a.txt").write_text("0\n1\n2\n")
    (src / "b.txt").write_text("0\n")
    first = rows(cms_stream(spark, str(src), "*.txt", None, "id", 50, fmt="text", checkpoint=ck,
                            max_files_per_trigger=1))
    (src / "c.txt").write_text("0\n5\n")
    second = rows(cms_stream(spark, str(src), "*.txt", None, "id", 50, fmt="text", checkpoint=ck))
    ids = spark.createDataFrame([(i,) for i in (0, 1, 2, 0, 0, 5)], "id long")
    assert sum(n for h, _, n in first if h == 0) == 4
    assert second == rows(C.cms_sketch(ids, "id", 50))
