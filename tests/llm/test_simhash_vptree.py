import random
import re

import numpy as np
import pytest
import xxhash

from lodestar.llm import simhash_vptree as S
from lodestar.llm.components import components


def simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def classes(ids, fps, t=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= t:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, k in enumerate(ids):
        if k is not None:
            low[find(i)] = min(k, low.get(find(i), k))
    return [low.get(find(i)) for i in range(len(ids))]


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice("the of an ERROR Größe blau x y z w v u".split()) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows = [(None, "null id text one two"), (7, None), (8, ""), (9, " \n"), (10, "One"), (11, "one")]
    for i in range(300):
        t = rng.choice(base).split(" ")
        if len(t) > 3 and rng.random() < .7:
            t[rng.randrange(len(t))] = rng.choice(["new", "THE", "x"])
        rows.append((100 + (i * 7919) % 997, rng.choice([" ", "\t", "\n "]).join(t)))
    rows += rows[20:25]
    df = spark.createDataFrame([(k, t, "a") for k, t in rows], "doc_id long, text string, fp string")
    fps = [simhash(t) for _, t in rows]
    want = [(k, f"{f:016x}", c) for (k, _), f, c in zip(rows, fps, classes([k for k, _ in rows], fps), strict=True)]
    got = S.near_duplicates(df)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    kept = S.kept_rows(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for *_, c in want if c is not None})
    assert kept.filter("doc_id is null").count() == sum(c is None for *_, c in want) == 1
    assert S.near_duplicates(df.filter("false")).count() == 0


@pytest.mark.parametrize("kind", ["spread", "tight"])
def test_tree_finds_every_pair(kind, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_PAIRS", 300)
    rng = np.random.default_rng(6)
    if kind == "spread":
        fps = rng.integers(0, 2**64, 1500, dtype=np.uint64)
        fps = np.concatenate([fps, fps[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))])
    else:  # many fingerprints within a few bits of one
        flips = [np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64) for _ in range(5)]
        fps = np.uint64(12345) ^ flips[0] ^ flips[1] ^ flips[2] ^ flips[3] ^ flips[4]
    fps = np.unique(fps)
    want = {(a, b) for a in range(len(fps)) for b in np.flatnonzero(np.bitwise_count(fps ^ fps[a]) <= 2) if a < b}
    nodes, loads = S.fit_tree(fps[::3], 24, 2)
    assert len(loads) > 4
    who, shard, stays = S.routed(nodes, fps, 2)
    assert sorted(who[stays]) == list(range(len(fps)))
    got = set()
    for s in range(len(loads)):
        res, vis = who[(shard == s) & stays], who[(shard == s) & ~stays]
        names = np.concatenate([res, vis])
        for a, b in S.near_pairs(fps[res], fps[vis], 2):
            got |= {(min(x, y), max(x, y)) for x, y in zip(names[a], names[b], strict=True)}
    assert got == want


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1001), (5, 5), (-3, 1000)]
    df = spark.createDataFrame(edges, "x long, y long")
    got = {r.vertex: r.root for r in components(df, "x", "y").collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: -3, 1001: -3, -3: -3}


def test_long_texts_go_piece_by_piece(monkeypatch):
    rng = random.Random(8)
    text = " \n".join("".join(rng.choice("abÄ") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    whole = S.fingerprint(text, 3)
    assert whole & (2**64 - 1) == simhash(text)
    for size in (1, 7, 1000):
        monkeypatch.setattr(S, "PIECE", size)
        assert S.fingerprint(text, 3) == whole
        assert S.fingerprint("One", 3) & (2**64 - 1) == simhash("One")


def test_kept_rows_carry_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d", 5, "p"), (2, "a b c d", 6, "q"), (3, "e f g h", 7, None)],
                               "doc_id long, text string, _a int, fp string")
    got = S.kept_rows(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(1, "a b c d", 5, "p"), (3, "e f g h", 7, None)]
