import pytest

from conftest import rows
from lodestar.operators import cluster as K

POINTS = [(0, [0.0, 0.0]), (1, [0.0, 2.0]), (2, [10.0, 0.0]), (3, [10.0, 2.0])]
CENTERS = [[0.0, 0.0], [10.0, 0.0]]


@pytest.fixture()
def points(spark):
    return spark.createDataFrame(POINTS, "vec_id long, features array<double>")


def test_round_zero_losses_and_update(points):
    new, loss = K.kmeans_step(points, CENTERS, "l2")
    assert loss == 8.0 and new == [[0.0, 1.0], [10.0, 1.0]]
    new1, loss1 = K.kmeans_step(points, CENTERS, "l1")
    assert loss1 == 4.0 and new1 == [[0.0, 1.0], [10.0, 1.0]]


def test_fit_losses(points):
    _, l2 = K.kmeans_fit(points, CENTERS, 2, "l2")
    _, l1 = K.kmeans_fit(points, CENTERS, 2, "l1")
    assert l2 == [8.0, 4.0] and l1 == [4.0, 4.0]


def test_l2_loss_non_increasing(points):
    _, losses = K.kmeans_fit(points, [[0.0, 0.0], [0.0, 2.0]], 4, "l2")
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))


def test_tie_goes_to_lower_index(spark):
    pt = spark.createDataFrame([(9, [5.0, 0.0])], "vec_id long, features array<double>")
    assert rows(K.kmeans_assign(pt, CENTERS, "l2")) == [(9, 0, 25.0)]


def test_empty_cluster_keep_or_drop(points):
    centers = CENTERS + [[100.0, 100.0]]
    kept, _ = K.kmeans_step(points, centers, "l2")
    assert kept[2] == [100.0, 100.0] and len(kept) == 3
    dropped, _ = K.kmeans_step(points, centers, "l2", drop_empty=True)
    assert len(dropped) == 2


def test_nan_points_are_dropped(spark):
    pt = spark.createDataFrame([(1, [float("nan"), 0.0]), (2, [1.0, 0.0])],
                               "vec_id long, features array<double>")
    assert [r[0] for r in rows(K.kmeans_assign(pt, CENTERS))] == [2]


def test_unknown_distance_rejected(points):
    with pytest.raises(ValueError):
        K.kmeans_assign(points, CENTERS, "cosine")


def test_wide_vector_path_matches_narrow(points, monkeypatch):
    from lodestar.operators import vector_sums as V
    want = K.kmeans_fit(points, CENTERS, 2, "l2")
    monkeypatch.setattr(V, "WIDE_DIM", 1)
    assert K.kmeans_fit(points, CENTERS, 2, "l2") == want


def test_iterations_are_written_per_round(spark, points, tmp_path):
    out = str(tmp_path / "iters")
    K.kmeans_fit(points, CENTERS, 2, "l2", iteration_dir=out)
    got = spark.read.parquet(out)
    assert rows(got.groupBy("iteration").agg({"loss": "max"})) == [(0, 8.0), (1, 4.0)]
    assert rows(got.filter("iteration = 1"), "cluster", "center") == [(0, [0.0, 1.0]),
                                                                     (1, [10.0, 1.0])]
