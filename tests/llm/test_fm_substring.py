import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import fm_substring as S


def brute(rows, window=13):
    found = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    order = lambda k: (k is None, k)
    first = {}
    for k, w in found:
        for i in range(len(w) - window + 1):
            seq = tuple(w[i:i + window])
            first[seq] = min(first.get(seq, (True, 0)), order(k) if k is not None else (True, 0))
    out = []
    for k, w in found:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (order(k) if k is not None else (True, 0)):
                gone |= set(range(i, i + window))
        out.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "a", "é", "日本"]) if rng.random() < .6 else f"w{rng.randrange(400)}"
    passages = [[word() for _ in range(rng.choice([12, 13, 14, 20, 60]))] for _ in range(12)]
    rows = [(None, " ".join(passages[0] + passages[3])), (3, None), (4, ""), (5, "a b"), (6, "x " * 40), (7, "x " * 50)]
    for i in range(n):
        w = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        rows.append(((i * 37) % 1009 + 10, rng.choice([" ", "\n", "\t \r\n"]).join(w) + rng.choice(["", " "])))
    return rows + rows[20:24]


@pytest.mark.parametrize(("hot", "buckets"), [(4096, 1), (3, 5), (0, 20)])
def test_against_brute_force(spark, monkeypatch, hot, buckets):
    monkeypatch.setattr(S, "HOT_DOCS", hot)  # in the driver; the functions are sent by value below
    monkeypatch.setattr(S, "BUCKETS", buckets)
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)  # several shards a bucket
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(S)
    try:
        rows = corpus(hot)
        df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, removed int")
        got = S.substring_dedup(df).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(S)
    mine = [(r.doc_id, r.n_words, sum(x.end - x.start for x in r.removed), r.kept) for r in got]
    assert sorted(mine, key=repr) == brute(rows)


def test_empty_table(spark):
    assert S.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_and_matching_statistics():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 4, 300), 0)
    text[[50, 120, 121]] = 0
    index = S.FMIndex(text)
    for size in (1, 2, 5, 13):
        for _ in range(40):
            at = rng.integers(0, len(text) - size)
            pattern = text[at:at + size]
            if (pattern == 0).any():
                continue
            low, high = np.array([0]), np.array([len(text)])
            for c in pattern[::-1]:
                low, high = index.extend(np.array([c]), low, high)
            where = [i for i in range(len(text) - size + 1) if (text[i:i + size] == pattern).all()]
            assert sorted(index.suffixes[low[0]:high[0]]) == where
    ends = np.array([i for i in range(13, len(text)) if not (text[i - 13:i] == 0).any()])
    length, _, _ = S.matching_statistics(index, text, ends, 13)
    for e, n in zip(ends, length, strict=True):
        occurs = lambda m, e=e: sum((text[i - m:i] == text[e - m:e]).all() for i in range(m, len(text) + 1)) > 1
        assert n == max(m for m in range(14) if occurs(m))


def test_least_ids():
    segments = ["a b c d ", "b c d e ", "x a b c ", "q r s "]
    least, upto = S.least_ids(pa.array([s.encode() for s in segments]), np.array([5, 3, 9, 1]), 3)
    assert least.tolist() == [5, 3, 3, 3, 9, 5, 1] and upto.tolist() == [0, 2, 4, 6, 7]


def test_oracle(spark):
    import duckdb

    from lodestar.llm.queries import ORACLES, QUERIES

    d = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view documents as select * from '{d}/documents.parquet'")
    want = duckdb.sql(ORACLES["op5_fm_substring"])
    got = QUERIES["op5_fm_substring"](spark, d).select(*want.columns)
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want.fetchall()) and any(r[2] for r in rows)
