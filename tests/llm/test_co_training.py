import random
import zlib

import numpy as np
import pyarrow as pa

from lodestar.llm import co_training as Q


def make(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < .7
        words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 90))]
        if not good:
            words = [w.upper() + "!!" for w in words] if rng.random() < .5 else [words[0]] * len(words)
        docs.append((i, rng.choice([" ", "\n"]).join(words), "en" if rng.random() < .5 else None, f"s{i % 3}", 10 * i))
        if i % 3:
            labels.append((i, int(good)))
    return docs, labels, {i: int(not (t.isupper() or len(set(t.split())) == 1)) for i, t, *_ in docs}


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels, truth = make(700)
    docs += [(5000, None, None, None, None), (5001, "", "en", "s", 0), (5001, "", "en", "s", 0), (None, "x", "en", "s", -5),
             (5002, "word " * 20_000, "de", "t", 9)]
    d = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 as score", "2 as label")
    lab = spark.createDataFrame([*labels, (9, None), (None, 1)], "doc_id long, quality int")
    got = Q.quality(d, lab).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > .97
    flipped = [(k, 1 - y) if zlib.crc32(str(k).encode()) % 4 == 2 else (k, y) for k, y in labels]
    again = Q.quality(d, spark.createDataFrame(flipped, "doc_id long, quality int")).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_without_labels(spark):
    d = spark.createDataFrame(make(5)[0], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {round(r.score, 6) for r in Q.quality(d, none).collect()} == {.5}
    assert Q.quality(d.filter("false"), none).count() == 0


def test_against_a_replay(spark):
    """The whole of co-training again, by plain Python over all rows at once."""
    docs, labels, truth = make(240, 9)
    labels = labels[:60]
    d = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: r for r in Q.quality(d, spark.createDataFrame(labels, "doc_id long, quality int"), draw_rows=10**6).collect()}
    label = {k: y for k, y in labels if zlib.crc32(str(k).encode()) % 4 != 2}
    keyed = spark.createDataFrame(docs, SCHEMA).select("doc_id", Q.F.pmod(Q.F.xxhash64(Q.F.lit(29), "doc_id"), Q.F.lit(1 << 30)).alias("p")).collect()
    place = {r.doc_id: r.p for r in keyed}
    order = sorted(label, key=lambda k: (place[k], label[k]))
    views = Q.Views()
    views.add(pa.array([t for _, t, *_ in docs]), [[r[j] for r in docs] for j in (2, 3, 4)])
    free = [i for i in range(len(docs)) if i not in label]
    fits = [[k for n, k in enumerate(order) if n % 3 != f] for f in range(4)]
    given = [({}, {}) for _ in fits]
    for turn in range(Q.ROUNDS + 1):
        models = []
        for f, own in enumerate(fits):
            pair = []
            for v in (0, 1):
                rows = own + sorted(given[f][v])
                y = np.array([label[k] for k in own] + [given[f][v][k] for k in sorted(given[f][v])], float)
                pair.append(Q.fit_logistic(views.pick(np.array(rows))[v], y, Q.WIDTHS[v], Q.L2[v]))
            models.append(pair)
        if turn == Q.ROUNDS:
            break
        n = max(2, int(Q.NAMED * len(free)))
        for f, own in enumerate(fits):
            share = np.mean([label[k] for k in own])
            for v in (0, 1):
                odds = views.pick(np.array(free))[v].dot(models[f][v][0]) + models[f][v][1]
                step = np.floor(np.clip(odds, -Q.REACH, Q.REACH) * Q.STEPS)
                ones = max(1, round(n * share))
                for y, many in ((1.0, ones), (0.0, max(1, n - ones))):
                    side = np.sort(step[step >= 0])[::-1] if y else np.sort(step[step < 0])
                    if len(side):
                        last = side[min(many, len(side)) - 1]
                        for k, s in zip(free, step, strict=True):
                            if (s >= last if y else s <= last):
                                given[f][1 - v].setdefault(k, y)
    held = np.zeros((2, len(order)))
    for v in (0, 1):
        for n, k in enumerate(order):
            w, b = models[n % 3][v]
            held[v, n] = views.pick(np.array([k]))[v].dot(w)[0] + b
    y = np.array([label[k] for k in order], float)
    scales = [Q.calibrate(held[v], y) for v in (0, 1)]
    odds = np.stack([a * held[v] + b for v, (a, b) in enumerate(scales)], 1)
    mix, bias = Q.fit_logistic(Q.Sparse([np.array([0, 1])] * len(order), odds.ravel()), y, 2, 1e-3)
    assert sum(len(g[v]) for g in given for v in (0, 1)) > 40
    for i, (k, *_) in enumerate(docs):
        each = [scales[v][0] * (views.pick(np.array([i]))[v].dot(models[3][v][0])[0] + models[3][v][1]) + scales[v][1] for v in (0, 1)]
        assert abs(got[k].text_score - 1 / (1 + np.exp(-each[0]))) < 1e-3 and abs(got[k].page_score - 1 / (1 + np.exp(-each[1]))) < 1e-3
        assert abs(got[k].score - 1 / (1 + np.exp(-(mix @ each + bias)))) < 1e-3


def test_named_rows_grow_with_the_table(spark):
    """Of all unlabelled rows the share NAMED is named, drawn from evenly."""
    rng = np.random.default_rng(1)
    n = 40_000
    odds = spark.createDataFrame([(int(i), *map(float, x)) for i, x in enumerate(rng.normal(0, 3, (n, 8)))],
                                 "rid long, " + ", ".join(f"o{k}_{v} double" for k in range(4) for v in (0, 1)))
    named = Q.name_surest(odds, [.5] * 4, 0, 10**9)
    assert abs(len(named) / (8 * Q.NAMED * n) - 1) < .05
    few = Q.name_surest(odds, [.5] * 4, 0, 100)
    assert set(few) <= set(named) and 8 * 2 * 60 < len(few) < 8 * 2 * 140
    assert few == Q.name_surest(odds, [.5] * 4, 0, 100)


def test_a_hot_labelled_id_is_one_row(spark):
    docs, labels, truth = make(300, 4)
    hot = [(1, f"some words {i} of a hot id", "en", "s", i) for i in range(300)]
    got = Q.quality(spark.createDataFrame(docs + hot, SCHEMA), spark.createDataFrame(labels + [(1, 1)] * 50, "doc_id long, quality int")).collect()
    assert len(got) == 600
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.doc_id > 1]) > .95


def test_long_texts_go_piece_by_piece(monkeypatch):
    text = pa.array(["Ein Wort!  12\nüber all\tes " * 700])
    whole = Q.layout(text), Q.text_view(text)
    for size in (50, 1000):
        monkeypatch.setattr(Q, "PIECE", size)
        assert np.allclose(Q.layout(text), whole[0])
        rows, values = Q.text_view(text)
        assert (rows[0] == whole[1][0][0]).all() and np.allclose(values, whole[1][1])


def test_long_metadata_differ_by_any_byte():
    text = pa.array(["a", "a", "a"])
    one, two, three = Q.page_view(text, [["x" + "/same" * 40, "y" + "/same" * 40, "x" + "/same" * 40]])
    assert (one == three).all() and (one != two).any()


def test_layout():
    rows = Q.layout(pa.array(["", "AB cd!\nAB 1", None]))
    assert not rows[0].any() and not rows[2].any()
    assert np.allclose(rows[1][4:10], [3 / 11, 1 / 11, 4 / 11, 1 / 11, 1 / 11, 0]) and np.allclose(rows[1][10:], [.75, .5])
