"""Inputs on which rows or work were once lost without a word."""

import time

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lodestar import session
from lodestar.functions.text import rtrim_ws
from lodestar.functions.vectors import significant
from lodestar.operators import cluster as K
from lodestar.operators import graph as G
from lodestar.operators import recommend as R
from lodestar.operators import sketch as C
from lodestar.operators import text as T
from lodestar.plans.iterate import LineageCutter
from lodestar.sources import sinks as IO
from lodestar.streaming import sketch_stream as ST


def test_listed_friends_without_an_own_row_get_one(spark):
    adj = spark.createDataFrame([(1, 2, 0), (1, 3, 1), (1, 4, 2)], "src long, dst long, pos int")
    got = {r.user_id: r.recs for r in G.recommend_friends_text(adj, mode="list_order").collect()}
    assert got == {1: "", 2: "3,4", 3: "4"}
    long = {(r.user_id, r.candidate) for r in G.recommend_friends(adj, mode="list_order").collect()}
    assert long == {(1, None), (2, 3), (2, 4), (3, 4)}


def test_rating_ids_of_any_range(spark):
    ratings = spark.createDataFrame([(0, -7, 3.0), (2**62, 5, 4.0)], "user long, item long, rating double")
    p, q = R.init_factors(ratings, "user", 3, 1), R.init_factors(ratings, "item", 3, 2)
    assert p.count() == q.count() == 2
    n, *_ = R.mf_objective(ratings, p, q, 0.1, 3)
    assert n == 2
    hist = R.mf_gd_fit(ratings, k=3, rounds=2)
    assert [t for t, _ in hist] == [0, 1, 2]


def test_diverging_fit_warns(spark):
    ratings = spark.createDataFrame([(1, 1, 1e200)], "user long, item long, rating double")
    with pytest.warns(RuntimeWarning, match="diverged"):
        hist = R.mf_gd_fit(ratings, k=2, lr=1e150, rounds=5)
    assert len(hist) < 6


def test_zero_score_items_are_ranked(spark):
    r = spark.createDataFrame([(1, 1), (1, 50), (2, 50), (2, 2), (3, 3)], "user long, item long")
    for f in (R.cf_user_user, R.cf_item_item):
        got = f(r, 1, 10, 20).orderBy("rank").collect()
        assert [x.item for x in got] == [2, 1, 3] and got[1].score == got[2].score == 0.0
    none = spark.createDataFrame([], "item long")
    assert {x.rate for x in R.hit_rate(R.cf_user_user(r, 1, 10), none).collect()} == {None}


def test_tiny_scores_rank_by_value(spark):
    scores = spark.createDataFrame([(i, 1e-12 * (10 - i)) for i in range(1, 10)], "page long, rank double")
    got = G.rank_extremes(scores, n=2)
    assert {(r.side, r.pos, r.page) for r in got.collect()} == {
        ("bottom", 1, 9), ("bottom", 2, 8), ("top", 1, 2), ("top", 2, 1)}
    x = spark.range(1).select(significant(F.lit(1.23456789e-20), 3).alias("a"), significant(F.lit(0.0), 3).alias("z")).first()
    assert x.a == pytest.approx(1.23e-20, rel=1e-9) and x.z == 0


def test_missing_centroids_raise(spark):
    pts = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "vec_id long, features array<double>")
    with pytest.raises(ValueError, match="7"):
        K.initial_centers(pts, [1, 7])


@pytest.mark.parametrize("parts", [None, 3])
def test_stream_over_a_file_or_a_folder(spark, tmp_path, parts):
    df = spark.range(1000).select((F.col("id") % 37).alias("user_id"))
    folder = tmp_path / "events.parquet"
    df.repartition(parts or 1).write.parquet(str(folder))
    path = folder if parts else next(folder.glob("part-*.parquet"))
    sketch = ST.cms_stream(spark, str(path), None, df.schema, "user_id", 50)
    assert C.cms_total(sketch).first()[0] == 1000


def test_stream_timeout_stops_and_raises(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("user_id"))
    df.repartition(40).write.parquet(str(tmp_path / "e"))
    with pytest.raises(TimeoutError):
        ST.cms_stream(spark, str(tmp_path / "e"), None, df.schema, "user_id", 10, timeout_s=0.01, max_files_per_trigger=1)
    assert not spark.streams.active


def test_short_records_are_counted(spark):
    df = spark.createDataFrame([("k a b c",), ("k a b",), ("",), (None,)], "value string")
    assert tuple(T.short_records(df).first()) == (4, 3)
    assert T.split_records(df).count() == 1
    assert tuple(T.short_records(df, tokens=2).first()) == (4, 2)


def test_long_run_of_blanks_is_linear(spark):
    df = spark.createDataFrame([("a" + " " * 1_000_000 + "b \t\n",)], "value string")
    t = time.time()
    assert df.select(F.length(rtrim_ws("value"))).first()[0] == 1_000_002
    assert T.word_count(df).count() == 2
    assert time.time() - t < 20


def test_null_keys_and_existing_folders(spark, tmp_path):
    path = str(tmp_path / "kv")
    df = spark.createDataFrame([(None, 5), ("a", None), ("b", 2)], "k string, n long")
    IO.write_kv_text(df, "k", "n", path)
    got = {tuple(r) for r in IO.read_kv_text(spark, path).collect()}
    assert got == {(None, 5), ("a", None), ("b", 2)}
    with pytest.raises(Exception, match="(?i)already exists"):
        IO.write_kv_text(df, "k", "n", path)


def test_an_iteration_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "it")
    for i, x in ((0, 1.0), (1, 2.0), (1, 3.0)):
        IO.write_iterations(spark.createDataFrame([(i, x)], "iteration int, loss double"), path)
    assert {(r.iteration, r.loss) for r in spark.read.parquet(path).collect()} == {(0, 1.0), (1, 3.0)}


def test_error_report_reads_its_table_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(300).select((F.col("id") % 7).alias("x")).mapInPandas(touch, "x long")
    out = C.cms_error(df, "x", 100)
    assert {(r.id, r.true_n) for r in out.collect()} == {(i, 300 // 7 + (i < 300 % 7)) for i in range(7)}
    assert seen.value == 300


def test_checkpoint_evaluates_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(100).mapInPandas(touch, "id long")
    assert LineageCutter(spark)(df, 0, force=True).count() == 100
    assert seen.value == 100


def test_session_keeps_what_was_submitted(monkeypatch):
    asked = {}

    class Builder:
        def appName(self, _):
            return self

        def master(self, m):
            asked["master"] = m
            return self

        def config(self, k, v):
            asked[k] = v
            return self

        def getOrCreate(self):
            return SparkSession.getActiveSession()

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    session.get_spark()
    assert not {"master", "spark.sql.shuffle.partitions", "spark.driver.memory"} & set(asked)
    session.get_spark(master="local[2]", shuffle_partitions=3)
    assert asked["master"] == "local[2]" and asked["spark.sql.shuffle.partitions"] == "3"


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_no_machine_local_folder_on_a_cluster(master):
    class Context:
        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, _k, default=None):
            return default

    fake = type("S", (), {"sparkContext": Context(), "conf": Conf()})()
    fake.sparkContext.master = master
    fake.sparkContext.getConf = lambda: Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake)


def test_global_index_moves_rows_once(spark):
    from lodestar.operators.sequence import with_global_index

    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    out = with_global_index(df, ["k"], n_parts=6)
    got = out.orderBy("k").collect()
    assert [r.idx for r in got] == list(range(5000)) and [r.k for r in got] == sorted(r.k for r in got)
    assert "hashpartitioning" not in out._jdf.queryExecution().sparkPlan().toString()


def test_hubs_are_split_by_their_output(spark):
    """A hub makes the square of its rows: 3 hubs of 60 among 400 nodes of 2
    are under a third of the input but nearly all of the output."""
    from lodestar.plans.skew import hot_keys

    rows = [(h, 1000 + i) for h in range(3) for i in range(60)] + [(10 + n, 2000 + n + j) for n in range(400) for j in range(2)]
    df = spark.createDataFrame(rows, "src long, dst long")
    by_input, by_output = hot_keys(df, "src", 4), hot_keys(df, "src", 4, power=2)
    assert not by_input and sorted(by_output.keys) == [0, 1, 2] and min(by_output.buckets) >= 2
    got = G.friend_candidates(df, top_n=100, mode="symmetric")
    mutual = {(r.user_id, r.candidate): r.n for r in got.collect()}
    assert mutual[1000, 1001] == mutual[1001, 1000] == 3 and all(mutual[b, a] == n for (a, b), n in mutual.items() if (b, a) in mutual)
