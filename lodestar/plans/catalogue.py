"""The query catalogue: each entry wires the test tables to one operator.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole tables.  Output column names match ``lodestar.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import baskets as B
from lodestar.operators import cluster as K
from lodestar.operators import graph as G
from lodestar.operators import joins as J
from lodestar.operators import linear as L
from lodestar.operators import packed as P
from lodestar.operators import recommend as R
from lodestar.operators import sgd as SGD
from lodestar.operators import sketch as C
from lodestar.operators import text as T
from lodestar.plans import layouts
from lodestar.plans.iterate import ScratchTables
from lodestar.session import scratch_path
from lodestar.sources import sinks as IO
from lodestar.sources import tables as S
from lodestar.streaming import sketch_stream as ST

Query = Callable[[SparkSession, str], DataFrame]


# -- text -------------------------------------------------------------------

def q_word_count(spark, sf_dir):
    return T.word_count(S.documents_text(spark, sf_dir))


def q_first_letter_count(spark, sf_dir):
    return T.first_letter_count(S.documents_text(spark, sf_dir))


def q_distinct_count_per_key(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    value = F.concat(F.to_date("ts").cast("string"), F.col("event_type"))
    return T.distinct_count_per_key(ev, "user_id", value)


def q_approx_distinct_per_key(spark, sf_dir):
    """Sketches of two parts of the events, written, then merged: the exact count
    per key and whether the estimate is within three standard errors of it."""
    ev = S.table(spark, sf_dir, "events")
    parts = []
    for part in (0, 1):
        path = scratch_path(spark, "distinct-sketch")
        some = ev.filter(F.pmod("event_id", F.lit(2)) == part)
        T.distinct_sketch(some, F.col("event_type"), F.col("user_id")).write.parquet(path)
        parts.append(spark.read.parquet(path))
    estimate = T.sketch_estimate(T.merge_sketches(*parts)).withColumnRenamed("n", "estimate")
    exact = T.distinct_count_per_key(ev.withColumnRenamed("event_type", "key"), "key", "user_id")
    return exact.join(estimate, "key", "left").select(
        "key", "n", (F.abs(F.col("estimate") - F.col("n")) <= T.sketch_error() * F.col("n") + 1).alias("within"))


def q_record_count(spark, sf_dir):
    """P2 + M3 over text lines: distinct records per key."""
    records = T.split_records(S.documents_text(spark, sf_dir).toDF("value"))
    return T.distinct_count_per_key(records)


def q_short_records(spark, sf_dir):
    return T.short_records(S.documents_text(spark, sf_dir).toDF("value"))


# -- baskets ----------------------------------------------------------------

def _basket_setup(spark, sf_dir):
    # the long-form basket items are read by every A-priori level: cache once
    items = S.conversation_items(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    support = B.support_threshold(S.conversation_count(spark, sf_dir))
    return items, support


def q_item_support(spark, sf_dir):
    items, support = _basket_setup(spark, sf_dir)
    return B.item_support(items, support)


def q_pair_support(spark, sf_dir):
    items, support = _basket_setup(spark, sf_dir)
    return B.pair_support(items, S.BASKET_COLS, support)


def q_order_pair_support(spark, sf_dir):
    """Parts ordered together at least twice; the parts allow far more pairs than
    the buckets, so the bitmap of hashed pairs is at work."""
    items = (S.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"))
             .distinct().persist(StorageLevel.MEMORY_AND_DISK))
    return B.pair_support(items, ["l_orderkey"], 2, buckets=1 << 16)


def q_pair_rules(spark, sf_dir):
    items, support = _basket_setup(spark, sf_dir)
    freq_items = B.item_support(items, support).persist()
    pairs = B.pair_support(items, S.BASKET_COLS, support, freq_items)
    return B.pair_rules(pairs, freq_items)


def q_triple_support(spark, sf_dir):
    items, support = _basket_setup(spark, sf_dir)
    return B.triple_support(items, S.BASKET_COLS, support)


def q_triple_rules(spark, sf_dir):
    items, support = _basket_setup(spark, sf_dir)
    freq_items = B.item_support(items, support).persist()
    pairs = B.pair_support(items, S.BASKET_COLS, support, freq_items).persist()
    triples = B.triple_support(items, S.BASKET_COLS, support, freq_items, pairs)
    return B.triple_rules(triples, pairs)


def q_frequent_itemsets(spark, sf_dir):
    conv = S.table(spark, sf_dir, "conversations").select(*S.BASKET_COLS, "text")
    n = S.conversation_count(spark, sf_dir)
    sets = B.frequent_itemsets(B.basket_arrays(conv, S.BASKET_COLS, "text"),
                               B.support_threshold(n), n)
    return sets.select(F.array_join("items", ",").alias("items"),
                       F.size("items").alias("size"), "n")


QUERIES: dict[str, Query] = {
    "word_count": q_word_count,
    "first_letter_count": q_first_letter_count,
    "distinct_count_per_key": q_distinct_count_per_key,
    "approx_distinct_per_key": q_approx_distinct_per_key,
    "record_count": q_record_count,
    "short_records": q_short_records,
    "item_support": q_item_support,
    "pair_support": q_pair_support,
    "order_pair_support": q_order_pair_support,
    "pair_rules": q_pair_rules,
    "triple_support": q_triple_support,
    "triple_rules": q_triple_rules,
    "frequent_itemsets": q_frequent_itemsets,
}


# -- graphs -----------------------------------------------------------------


RANK_DIGITS = 10

#: Rounds of the queries over packed blocks.
PACKED_ROUNDS = 10


def _g1_friends(spark, sf_dir):
    return S.undirected(S.succession_graph(spark, sf_dir))


def _g2(spark, sf_dir):
    return S.succession_graph(spark, sf_dir)


def q_friends_symmetric(spark, sf_dir):
    return G.recommend_friends(_g1_friends(spark, sf_dir), 10, "symmetric")


def q_friends_list_order(spark, sf_dir):
    return G.recommend_friends_text(_g1_friends(spark, sf_dir), 10, "list_order")


def q_pagerank_edge(spark, sf_dir):
    ranks = G.pagerank_edge(_g2(spark, sf_dir), rounds=10, damping=0.85)
    return ranks.select("page", F.round("rank", RANK_DIGITS).alias("rank"))


def _power_ranks(spark, sf_dir):
    return G.pagerank_power(_g2(spark, sf_dir), rounds=40, beta=0.8)


def q_pagerank_power(spark, sf_dir):
    return _power_ranks(spark, sf_dir).select("page", F.round("rank", RANK_DIGITS).alias("rank"))


def q_hits_scores(spark, sf_dir):
    hs = G.hits(_g2(spark, sf_dir), rounds=40)
    return hs.select("page", F.round("hub", RANK_DIGITS).alias("hub"),
                     F.round("authority", RANK_DIGITS).alias("authority"))


def q_pagerank_packed(spark, sf_dir):
    ranks = P.pagerank_power(_g2(spark, sf_dir), rounds=PACKED_ROUNDS, beta=0.8)
    return ranks.select("page", F.round("rank", RANK_DIGITS).alias("rank"))


def q_hits_packed(spark, sf_dir):
    hs = P.hits(_g2(spark, sf_dir), rounds=PACKED_ROUNDS)
    return hs.select("page", F.round("hub", RANK_DIGITS).alias("hub"),
                     F.round("authority", RANK_DIGITS).alias("authority"))


def q_rank_extremes(spark, sf_dir):
    return G.rank_extremes(_power_ranks(spark, sf_dir), "rank", "page", 5)


QUERIES.update({
    "friends_symmetric": q_friends_symmetric,
    "friends_list_order": q_friends_list_order,
    "pagerank_edge": q_pagerank_edge,
    "pagerank_power": q_pagerank_power,
    "hits_scores": q_hits_scores,
    "pagerank_packed": q_pagerank_packed,
    "hits_packed": q_hits_packed,
    "rank_extremes": q_rank_extremes,
})


# -- k-means and SVM --------------------------------------------------------


KMEANS_SEEDS = list(range(10))
KMEANS_ROUNDS = 21
SVM_C = 100.0
#: (learning rate, stop at percent change, most rounds): rates for unit vectors, under which the
#: stop rule takes tens to hundreds of rounds
SVM_BATCH = (3e-5, 0.25, 2000)
SVM_MINIBATCH = (1.3e-4, 0.01, 6000)
SVM_BATCH_SIZE = 20
SVM_BIAS = 0.1


def svm_fixed_weights(dim: int) -> list[float]:
    """The fixed model of ``svm_cost_gradient``: w_d = 0.01 * (d mod 5 - 2)."""
    return [0.01 * ((d % 5) - 2) for d in range(dim)]


def _points(spark, sf_dir):
    return S.embeddings_points(spark, sf_dir)


def _assign(distance):
    def q(spark, sf_dir):
        pts = _points(spark, sf_dir)
        centers = K.initial_centers(pts, KMEANS_SEEDS)
        out = K.kmeans_assign(pts, centers, distance)
        return out.select("vec_id", "cluster", F.round("dist", 6).alias("dist"))
    return q


def _fit_loss(distance):
    def q(spark, sf_dir):
        pts = _points(spark, sf_dir)
        centers = K.initial_centers(pts, KMEANS_SEEDS)
        _, losses = K.kmeans_fit(pts, centers, KMEANS_ROUNDS, distance)
        return K.loss_frame(spark, losses)
    return q


def q_kmeans_fit_centers(spark, sf_dir):
    """Centroids after the k-means rounds, long form ``(cluster, dim, value)``."""
    pts = _points(spark, sf_dir)
    centers, _ = K.kmeans_fit(pts, K.initial_centers(pts, KMEANS_SEEDS), KMEANS_ROUNDS, "l2")
    return K.centers_frame(spark, centers).select(
        "cluster", F.posexplode("center").alias("dim", "value")).select(
        "cluster", "dim", F.round("value", 6).alias("value"))


def _svm_rows(spark, sf_dir):
    return L.svm_rows(_points(spark, sf_dir))


def _dim(spark, sf_dir):
    return len(_points(spark, sf_dir).select("features").first()[0])


def q_svm_cost_gradient(spark, sf_dir):
    dim = _dim(spark, sf_dir)
    _, dw, db = L.svm_cost_gradient(_svm_rows(spark, sf_dir), svm_fixed_weights(dim), SVM_BIAS,
                                    SVM_C)
    rows = [(d, float(g)) for d, g in enumerate(dw)] + [(-1, float(db))]
    return spark.createDataFrame(rows, "dim int, dw double").select(
        "dim", F.round("dw", 6).alias("dw"))


def _svm_batch(spark, sf_dir):
    lr, stop, most = SVM_BATCH
    return L.svm_batch_fit(_svm_rows(spark, sf_dir), _dim(spark, sf_dir), SVM_C, lr, stop, most)


def _svm_minibatch(spark, sf_dir):
    lr, stop, most = SVM_MINIBATCH
    return L.svm_minibatch_fit(_svm_rows(spark, sf_dir), _dim(spark, sf_dir), SVM_C, lr, SVM_BATCH_SIZE, stop, most)


def q_svm_batch_fit(spark, sf_dir):
    return L.history_frame(spark, _svm_batch(spark, sf_dir)[2], "pct_change")


def q_svm_batch_model(spark, sf_dir):
    return L.model_frame(spark, *_svm_batch(spark, sf_dir)[:2])


def q_svm_minibatch_fit(spark, sf_dir):
    return L.history_frame(spark, _svm_minibatch(spark, sf_dir)[2], "smoothed")


def q_svm_minibatch_model(spark, sf_dir):
    return L.model_frame(spark, *_svm_minibatch(spark, sf_dir)[:2])


QUERIES.update({
    "kmeans_assign_l2": _assign("l2"),
    "kmeans_assign_l1": _assign("l1"),
    "kmeans_fit_loss": _fit_loss("l2"),
    "kmeans_fit_l1_loss": _fit_loss("l1"),
    "kmeans_fit_centers": q_kmeans_fit_centers,
    "svm_cost_gradient": q_svm_cost_gradient,
    "svm_batch_fit": q_svm_batch_fit,
    "svm_batch_model": q_svm_batch_model,
    "svm_minibatch_fit": q_svm_minibatch_fit,
    "svm_minibatch_model": q_svm_minibatch_model,
})


# -- recommendation ---------------------------------------------------------


CF_USER = 499
CF_BELOW_ITEM = 1000
CF_TOP = 20
MF_K = 4
MF_REG = 0.2
MF_LR = 1e-4
MF_ROUNDS = 3
MF_DIGITS = 3


def q_cf_user_user(spark, sf_dir):
    out = R.cf_user_user(S.purchase_matrix(spark, sf_dir), CF_USER, CF_BELOW_ITEM, CF_TOP)
    return out.select("item", F.round("score", 6).alias("score"), "rank")


def q_cf_item_item(spark, sf_dir):
    out = R.cf_item_item(S.purchase_matrix(spark, sf_dir), CF_USER, CF_BELOW_ITEM, CF_TOP)
    return out.select("item", F.round("score", 6).alias("score"), "rank")


def q_cf_hit_rate(spark, sf_dir):
    r = S.purchase_matrix(spark, sf_dir).persist()
    actual = r.filter((F.col("user") == CF_USER) & (F.col("item") < CF_BELOW_ITEM)).select("item")
    uu = R.hit_rate(R.cf_user_user(r, CF_USER, CF_BELOW_ITEM, CF_TOP), actual)
    ii = R.hit_rate(R.cf_item_item(r, CF_USER, CF_BELOW_ITEM, CF_TOP), actual)
    return (uu.select("k", F.round("rate", 10).alias("uu_rate"))
            .join(ii.select("k", F.round("rate", 10).alias("ii_rate")), "k", "full"))


def _mf_factors(spark, ratings):
    return R.init_factors(ratings, "user", MF_K, 1), R.init_factors(ratings, "item", MF_K, 2)


def q_mf_objective(spark, sf_dir):
    ratings = S.quantity_ratings(spark, sf_dir).persist()
    p, q = _mf_factors(spark, ratings)
    n, sse, reg, obj = R.mf_objective(ratings, p, q, MF_REG, MF_K)
    return spark.createDataFrame([(n, sse, reg, obj)],
                                 "n long, sse double, reg double, objective double").select(
        "n", *[F.round(c, MF_DIGITS).alias(c) for c in ("sse", "reg", "objective")])


def q_mf_gd_fit(spark, sf_dir):
    hist = R.mf_gd_fit(S.quantity_ratings(spark, sf_dir), MF_K, MF_REG, MF_LR, MF_ROUNDS)
    return spark.createDataFrame(hist, "iteration int, objective double").select(
        "iteration", F.round("objective", MF_DIGITS).alias("objective"))


SGD_EPOCHS = 41
SGD_K = 20
#: Quantities reach 50; the rate is set for ratings of up to 5.
SGD_SCALE = 10.0


def q_mf_sgd_fit(spark, sf_dir):
    """Per-rating updates, 41 epochs of k = 20: the objective of each epoch."""
    ratings = S.quantity_ratings(spark, sf_dir).withColumn("rating", F.col("rating") / SGD_SCALE)
    _, _, hist = SGD.mf_sgd_fit(ratings, SGD_K, MF_REG, 0.01, SGD_EPOCHS)
    return spark.createDataFrame(hist, "iteration int, objective double").select(
        "iteration", F.round("objective", MF_DIGITS).alias("objective"))


def q_mf_als_fit(spark, sf_dir):
    """What the model is worth: its root mean squared error is under 0.8 of the
    ratings' standard deviation, which their mean alone would have."""
    with ScratchTables(spark) as scratch:
        ratings = scratch.write(S.quantity_ratings(spark, sf_dir), "als-ratings")
        model = R.mf_als_fit(ratings, rank=20, reg=0.2)
        n, n_users, n_items, sse = R.mf_als_score(ratings, model)
        spread = ratings.agg(F.stddev_pop("rating")).first()[0]
    sums = spark.createDataFrame([(n, n_users, n_items, sse, spread)], "n long, n_users long, n_items long, sse double, spread double")
    return sums.select("n", "n_users", "n_items", (F.sqrt(F.col("sse") / F.col("n")) < 0.8 * F.col("spread")).alias("fits"))


QUERIES.update({
    "cf_user_user": q_cf_user_user,
    "cf_item_item": q_cf_item_item,
    "cf_hit_rate": q_cf_hit_rate,
    "mf_objective": q_mf_objective,
    "mf_gd_fit": q_mf_gd_fit,
    "mf_sgd_fit": q_mf_sgd_fit,
    "mf_als_fit": q_mf_als_fit,
})


# -- sketches, streaming, sinks, positional join ----------------------------


CMS_TEST_BUCKETS = 10_000


def q_cms_sketch(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events").select("user_id")
    return C.cms_sketch(ev, "user_id", CMS_TEST_BUCKETS)


def q_cms_estimate(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events").select("user_id")
    sketch = C.cms_sketch(ev, "user_id", CMS_TEST_BUCKETS)
    probes = (ev.select(F.col("user_id").alias("id"))
              .unionByName(S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))))
    return C.cms_estimate(sketch, probes, "id", CMS_TEST_BUCKETS)


def q_cms_error(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem").select("l_partkey")
    return C.cms_error(li, "l_partkey", CMS_TEST_BUCKETS)


def q_cms_stream(spark, sf_dir):
    schema = S.table(spark, sf_dir, "events").schema
    return ST.cms_stream(spark, f"{sf_dir}/events.parquet", None, schema, "user_id", CMS_TEST_BUCKETS)


def q_cms_stream_probe(spark, sf_dir):
    """T2 + T3: probe the drained sketch; ``seen`` is its running total."""
    sketch = q_cms_stream(spark, sf_dir)
    ev = S.table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    probes = ev.unionByName(S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")))
    seen = C.cms_total(sketch).first()[0]
    return C.cms_estimate(sketch, probes, "id", CMS_TEST_BUCKETS).withColumn("seen", F.lit(seen).cast("long"))


def q_cms_distinct_ids(spark, sf_dir):
    """How many distinct ids the error report has."""
    li = S.table(spark, sf_dir, "lineitem").select("l_partkey")
    return C.cms_error(li, "l_partkey", CMS_TEST_BUCKETS).agg(F.count("id").alias("n_ids"))


def q_sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "word-count-tsv")
    IO.write_kv_text(q_word_count(spark, sf_dir), "token", "n", path)
    return IO.read_kv_text(spark, path, "string", "long").select(
        "key", F.col("value").alias("n"))


def q_positional_join(spark, sf_dir):
    labels = S.table(spark, sf_dir, "labels").orderBy("doc_id")
    path_a, path_b = scratch_path(spark, "labels-quality"), scratch_path(spark, "labels-toxic")
    labels.select(F.col("quality").cast("string")).write.text(path_a)
    labels.select(F.col("toxic").cast("string")).write.text(path_b)
    z = J.zip_text_files(spark, path_a, path_b, ("quality", "toxic"))
    return z.select("idx", F.col("quality").cast("int"), F.col("toxic").cast("int"))


QUERIES.update({
    "cms_sketch": q_cms_sketch,
    "cms_estimate": q_cms_estimate,
    "cms_error": q_cms_error,
    "cms_stream": q_cms_stream,
    "cms_stream_probe": q_cms_stream_probe,
    "cms_distinct_ids": q_cms_distinct_ids,
    "sink_roundtrip": q_sink_roundtrip,
    "positional_join": q_positional_join,
})
QUERIES.update(layouts.QUERIES)
