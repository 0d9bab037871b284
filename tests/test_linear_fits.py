"""The SVM fits against plain numpy loops over the whole matrix."""

import numpy as np
import pytest

from lodestar.operators import linear as L


def table(spark, n=230, dim=5, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, dim))
    y = np.where(x @ np.arange(dim) + rng.normal(0, 2, n) > 0, 1, -1)
    ids = rng.permutation(n * 3)[:n]
    rows = [(int(i), [float(v) for v in a], int(b)) for i, a, b in zip(ids, x, y)]
    return spark.createDataFrame(rows, "row_id long, features array<double>, y int").repartition(5), x, y, ids


def plain(x, y, ids, lr, stop, most, size=None, c=100.0):
    n, w, b, hist, change = len(y), np.zeros(x.shape[1]), 0.0, [], None
    place = np.empty(n, int)
    place[np.lexsort((ids, ids * 48271 % 2147483647))] = np.arange(n)
    batch = place // size if size else np.zeros(n, int)
    for k in range(most):
        m = y * (x @ w + b)
        cost = 0.5 * w @ w + c * np.maximum(0, 1 - m).sum()
        v = (m < 1) & (batch == k % (batch.max() + 1))
        w, b = w - lr * (w - c * (y[v] @ x[v])), b + lr * c * y[v].sum()
        if k:
            pct = abs(hist[-1][1] - cost) * 100 / hist[-1][1]
            change = 0.5 * (change or 0.0) + 0.5 * pct if size else pct
        hist.append((k, cost, change))
        if k and change <= stop:
            break
    return w, b, hist


def same(got, want):
    assert len(got[2]) == len(want[2])
    assert np.allclose(got[0], want[0]) and got[1] == pytest.approx(want[1])
    for a, b in zip(got[2], want[2]):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1]) and (a[2] is b[2] is None or a[2] == pytest.approx(b[2], abs=1e-9))


def test_batch_runs_to_its_stop_rule(spark):
    df, x, y, ids = table(spark)
    want = plain(x, y, ids, 3e-5, 0.25, 2000)
    assert 20 < len(want[2]) < 2000
    same(L.svm_batch_fit(df, 5, lr=3e-5, stop=0.25), want)


@pytest.mark.parametrize("size,lr", [(20, 1e-4), (1, 1e-4)])
def test_minibatch_and_single_rows(spark, monkeypatch, size, lr):
    """Thousands of rounds in dozens of jobs; batches of 1 are stochastic descent."""
    monkeypatch.setattr(L, "SEGMENT", 64)
    df, x, y, ids = table(spark)
    want = plain(x, y, ids, lr, 0.01, 700, size)
    assert len(want[2]) > 100
    same(L.svm_minibatch_fit(df, 5, lr=lr, batch_size=size, stop=0.01, max_rounds=700), want)


def test_a_new_run_goes_on_from_the_last_state(spark, monkeypatch):
    from lodestar.session import scratch_path
    monkeypatch.setattr(L, "SEGMENT", 10)
    df, x, y, ids = table(spark)
    for fit, size, lr in ((L.svm_batch_fit, None, 3e-5), (L.svm_minibatch_fit, 20, 1e-4)):
        at = scratch_path(spark, "svm-state")
        fit(df, 5, lr=lr, stop=0.0, max_rounds=20, state_dir=at)  # as if lost after 20 rounds
        done, jobs = fit(df, 5, lr=lr, stop=0.0, max_rounds=45, state_dir=at), []
        same(done, plain(x, y, ids, lr, 0.0, 45, size))
        monkeypatch.setattr(L, "_block_sums", lambda *a: jobs.append(1))
        assert fit(df, 5, lr=lr, stop=0.0, max_rounds=20, state_dir=at)[2][:20] == done[2][:20] and not jobs
        monkeypatch.undo()
        monkeypatch.setattr(L, "SEGMENT", 10)


def test_odd_rows(spark):
    schema = "row_id long, features array<double>, y int"
    empty = spark.createDataFrame([], schema)
    for fit in (L.svm_batch_fit, L.svm_minibatch_fit):
        assert fit(empty, 3) == ([0.0] * 3, 0.0, [(0, 0.0, None)])
    odd = spark.createDataFrame([(1, None, 1), (2, [1.0, None], 1), (3, [1.0, 2.0], None), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)], schema)
    assert L.svm_batch_fit(odd, 2, max_rounds=1)[2] == [(0, 200.0, None)]
