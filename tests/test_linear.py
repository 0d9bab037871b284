import pytest

from conftest import rows
from lodestar.operators import linear as L
from lodestar.operators.evaluate import percent_changes, smoothed_changes


@pytest.fixture()
def svm(spark):
    data = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], -1), (2, [2.0, 2.0], 1)]
    return spark.createDataFrame(data, "row_id long, features array<double>, y int")


def test_hinge_cost_and_gradient(svm):
    cost, dw, db = L.svm_cost_gradient(svm, [0.5, 0.0], 0.0, 100.0)
    assert cost == pytest.approx(150.125)
    assert dw == pytest.approx([-99.5, 100.0]) and db == 0.0


def test_batch_fit_stops_on_change(svm):
    _, _, hist = L.svm_batch_fit(svm, 2, lr=1e-3, stop=0.25, max_rounds=50)
    assert hist[0][2] is None and hist[0][1] == pytest.approx(300.0)
    assert len(hist) == 50 or hist[-1][2] <= 0.25


def test_minibatch_order_is_a_partition(spark):
    df = spark.range(0, 45).withColumnRenamed("id", "row_id")
    b = L.minibatch_order(df, 20)
    sizes = sorted(r[1] for r in b.groupBy("batch").count().collect())
    assert sizes == [5, 20, 20]


def test_stop_rule_windows(spark):
    hist = spark.createDataFrame([(0, 100.0), (1, 90.0), (2, 81.0)], "iteration int, cost double")
    got = rows(smoothed_changes(hist), "iteration", "pct_change", "smoothed")
    assert got[0] == (0, None, None)
    assert got[1][1:] == pytest.approx((10.0, 5.0)) and got[2][1:] == pytest.approx((10.0, 7.5))
    assert rows(percent_changes(hist), "pct_change")[1:] == [(pytest.approx(10.0),)] * 2
    assert L.pct_change(100.0, 90.0) == pytest.approx(10.0)


def test_wide_vector_path_matches_narrow(svm, monkeypatch):
    from lodestar.operators import vector_sums as V
    want = L.svm_cost_gradient(svm, [0.5, 0.0], 0.0, 100.0)
    monkeypatch.setattr(V, "WIDE_DIM", 1)
    assert L.svm_cost_gradient(svm, [0.5, 0.0], 0.0, 100.0) == want
