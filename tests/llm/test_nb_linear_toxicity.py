import random
import zlib

import numpy as np

from lodestar.llm import nb_linear_toxicity as T
from lodestar.llm.linear import Sparse, calibrate, fit_logistic, sigmoid


def test_features_are_the_distinct_ngrams_of_each_text():
    texts = ["", "ab", "Abcab cabca", "é\U0001f600é\U0001f600é", "x" * 500, "", "ab"]
    grams = [{t2[i:i + n] for n in T.ORDERS for i in range(len(t2) - n + 1)}
             for t2 in (f" {t.lower()} " for t in texts)]
    got = T.features(texts, 20)
    assert [len(f) for f in got] == [len(g) for g in grams]  # no collision among these few
    assert all((np.diff(f) > 0).all() for f in got)
    assert (got[1] == got[6]).all()
    wanted = np.zeros(1 << 20, bool)
    wanted[got[2][::2]] = True
    assert (T.features(texts, 20, wanted)[2] == got[2][::2]).all()


def test_logistic_and_calibration():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(20) < .3) for _ in range(3000)]
    true = np.concatenate([rng.normal(0, 2, 10), np.zeros(10)])
    p = sigmoid(np.array([true[r].sum() - 1 for r in rows]))
    y = (rng.random(3000) < p).astype(float)
    w, b = fit_logistic(Sparse(rows), y, 20, 1e-5)
    assert np.abs(w - true).max() < .6 and abs(b + 1) < .6
    a, c = calibrate(Sparse(rows).dot(w) * 3, y)
    assert abs(a * 3 - 1) < .1 and abs(c - b) < .1


def make(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < .15
        w = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(["zorkish", "Quxly"])
        docs.append((i, " ".join(w), "s"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = make(900)
    docs += [(5000, None, "s"), (5001, "", "s"), (5001, "", "s"), (None, "zorkish quxly zorkish", "s"), (5002, "zorkish " * 9000, "s")]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (6000, None), (None, 1)], "doc_id long, toxic int")
    got = T.toxicity(d, lab).collect()
    assert len(got) == len(docs)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > .95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .3) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[5000].score == by[5001].score < .3 < by[5002].score and by[None].predicted == 1
    # held-out labels are never read
    flipped = [(k, 1 - y) if zlib.crc32(str(k).encode()) % 4 == 2 else (k, y) for k, y in labels]
    again = T.toxicity(d, spark.createDataFrame(flipped, "doc_id long, toxic int")).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_without_both_classes(spark):
    d = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in T.toxicity(d, none).collect()] == [0, 0]
    assert T.toxicity(d.filter("false"), none).count() == 0


def test_every_significant_feature_has_a_weight(spark):
    """A thousand toxic words, each in a few documents: no cap leaves any out."""
    rng = random.Random(3)
    words = ["".join(rng.choice("bcdfghjklmnpqrstvwxyz") for _ in range(9)) for _ in range(1000)]
    toxic = words * 12
    rng.shuffle(toxic)
    rows = [(i, " ".join(toxic[30 * i:30 * i + 30]), 1) for i in range(400)]
    rows += [(i, " ".join(rng.choice(["aea", "eoo", "uia", "oue"]) for _ in range(20)), 0) for i in range(400, 2800)]
    training = spark.createDataFrame(rows, "key long, text string, label int").persist()
    z = T.ratios(*T.class_counts(training, T.BITS), 400, 2400)[1]
    weights, _ = T.train(training)
    assert (weights != 0).sum() == (z >= T.MIN_Z).sum() > 16_384
    held = T.features([f" {w} " for w in words], T.BITS)
    assert min(weights[f].sum() for f in held) > 0


def rare(spark, positives):
    """5000 clean rows and few toxic ones, all of which say one word."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["aea", "eoo", "uia", "oue"]) for _ in range(20)), 0) for i in range(5000)]
    rows += [(6000 + i, f"aea zorkish eoo {i}", 1) for i in range(positives)]
    return spark.createDataFrame(rows, "key long, text string, label int")


def test_rare_labels_are_in_the_fit(spark):
    texts = spark.createDataFrame([(1, "uia zorkish oue"), (2, "uia aea oue eoo")], "doc_id long, text string")
    for positives, least in ((4, T.THRESHOLD), (1, 0.1)):  # one alone: the ratios are the weights
        model = T.train(rare(spark, positives), fit_rows=50)
        by = {r.doc_id: r.score for r in T.score(texts, *model).collect()}
        assert by[1] > least > 2 * by[2], (positives, by)


def test_a_hot_id_does_not_fill_the_sample(spark):
    """A third of the rows have one id, with one text or many."""
    docs, labels = make(1500, 6)
    for hot in ([(7, "aea eoo", 0)] * 700, [(7, f"aea eoo {i}", 0) for i in range(700)]):
        rows = [(i, t, y) for (i, t, _), (_, y) in zip(docs, labels, strict=True)] + hot
        training = spark.createDataFrame(rows, "key long, text string, label int")
        model = T.train(training, fit_rows=300)
        got = T.score(spark.createDataFrame(docs, "doc_id long, text string, s string"), *model).collect()
        assert np.mean([(r.score >= T.THRESHOLD) == dict(labels)[r.doc_id] for r in got]) > .95


def test_long_texts_go_piece_by_piece(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdeé ÀX") for _ in range(5000))
    whole = T.features([text, "x"], 20)
    for size in (1, 64, 4999):
        monkeypatch.setattr(T, "PIECE", size)
        again = T.features([text, "x"], 20)
        assert (again[0] == whole[0]).all() and (again[1] == whole[1]).all()


def test_score_against_brute_force(spark):
    """The model's margin is the sum of its weights over a text's n-grams, each once."""
    docs, labels = make(400, 3)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, s string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    training = T.training_rows(d, lab, "toxic", T.fold(T.F.col("key"), 4) != 2)
    weights, bias = T.train(training)
    known = {}
    for t in {t for _, t, _ in docs}:
        low = f" {t.lower()} "
        grams = sorted({low[i:i + n] for n in T.ORDERS for i in range(len(low) - n + 1)})
        total = bias
        for g in grams:
            if g not in known:
                # a polynomial in the code points, the last one first
                h = sum(ord(c) * pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j, c in enumerate(reversed(g))) + len(g)
                known[g] = int(T.mix64(np.array([h % (1 << 64)], np.uint64))[0]) >> 64 - T.BITS
        total += sum(float(weights[b]) for b in {known[g] for g in grams})
        known[t] = 1 / (1 + np.exp(-total))
    got = T.toxicity(d, lab).collect()
    assert all(abs(r.score - known[dict((k, t) for k, t, _ in docs)[r.doc_id]]) < 1e-6 for r in got)


def test_fit_against_plain_descent():
    """The blocks of a fit give the model that dense gradient descent finds."""
    rng = np.random.default_rng(2)
    dense = rng.random((300, 12)) < .3
    y = (rng.random(300) < sigmoid(dense @ np.linspace(-2, 2, 12))).astype(float)
    stack = []
    for part in (slice(0, 100), slice(100, 300)):
        b = T.Blocks()
        for row in dense[part]:
            b.add(np.flatnonzero(row))
        b.close()
        stack.append(b)
    scale, weight = np.linspace(.5, 1.5, 12), 1 + rng.random(300)
    w, b = fit_logistic(T.Stack(stack), y, 12, 1e-2, scale, weight)
    v, c = np.zeros(12), 0.0
    for _ in range(20000):
        err = weight * (sigmoid(dense @ (v * scale) + c) - y) / weight.sum()
        v, c = v - 0.5 * ((err @ dense) * scale + 1e-2 * v), c - 0.5 * err.sum()
    assert np.abs(v * scale - w).max() < 1e-2 and abs(b - c) < 1e-2
