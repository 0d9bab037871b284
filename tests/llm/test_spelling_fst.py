import random
import re
import zlib
from collections import Counter

import numpy as np

from lodestar.llm import spelling_fst as S
from lodestar.llm.queries import QUERIES

D = "/root/testdata/sf0.001"


def count(rows, noise=199, least=6):
    words = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % noise == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            if len(run) >= least:
                words[run] += 1
    return words


def neighbours(words):
    """word -> near words, over all words that a deletion makes equal."""
    by = {}
    for w in words:
        for i in range(len(w) + 1):
            by.setdefault((w[:i], w[i:]), set()).add(w)        # w with a gap before i
            if i < len(w):
                by.setdefault((w[:i], w[i + 1:]), set()).add(w)  # w without its i-th
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if b != a}
    return near


def brute(rows, least=6, min_count=5, ratio=5, noise=199):
    n = {w: c for w, c in count(rows, noise, least).items() if c >= min_count}
    near, form = neighbours(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n int, word string")
    return sorted(map(tuple, S.variants(df, **more).collect()))


def test_composition_against_all_pairs():
    rng = random.Random(1)
    for _ in range(200):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(4, 5))) for _ in range(rng.randint(2, 60))})
        near = neighbours(words)
        first = lambda x, y: next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        for lo, hi in ((0, 5), (0, 2), (2, 4), (4, 5)):
            group = np.cumsum([i == 0 or words[i][:lo] != words[i - 1][:lo] for i in range(len(words))])
            i, j = S.near_pairs(group, S.matrix(words, 5), lo, hi)
            got = sorted(tuple(sorted((words[a], words[b]))) for a, b in zip(i.tolist(), j.tolist(), strict=True))
            assert got == sorted((x, y) for x in words for y in near[x] if x < y and min(len(x), len(y)) == 4 and lo <= first(x, y) < hi)


def test_states_are_minimal():
    words = sorted(a + b + c for a in "abc" for b in "xy" for c in ("ing", "ed\0", "s\0\0"))
    fsa = S.Acceptor(np.zeros(len(words), int), np.array([[ord(c) for c in w] for w in words], np.uint32), 0)
    # the start, after abc, after xy; then what is left: ng, d0, 00, g, 0 and nothing
    assert len(fsa.first) - 1 == 9 and len(fsa.letter) == 3 + 2 + 3 + 3 + 2


def test_against_brute_force(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(6, 9))) for _ in range(40)] + ["Straße", "ÀÉÎõü÷", "repeated", "aaaaaaa"]
    rows = []
    for i in range(1500):
        line = []
        for _ in range(20):
            w = rng.choice(stems[:8] if rng.random() < 0.7 else stems)
            if rng.random() < 0.3:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1:], w[:p] + rng.choice("aé") + w[p:], w[:p] + rng.choice("xe") + w[p + 1:]])
            line.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((None if i % 50 == 0 else i % 1400, rng.choice([" ", "-", "ł", "1", "\n"]).join(line)))
    rows += [(1, None), (2, ""), (3, "1234 €"), (4, "lang" * 30_000), (5, "zz" * 40 + " " + "zz" * 40 + "y")]
    want = brute(rows, noise=3)
    assert len(want) > 100 and run(spark, rows, noise=3) == want
    # intervals halved again and again give the same pairs
    assert run(spark, rows, limit=3) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(1, "short")] * 9) == []


def test_chains_of_forms(spark):
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    rows = [(1, " ".join([w] * (5 ** (i + 1)))) for i, w in enumerate(chain)]
    got = {r[0]: r for r in run(spark, rows, noise=1 << 40)}
    assert all(got[w][2] == chain[-1] for w in chain) and got[chain[0]][1] == chain[1] and got[chain[-1]][1] is None


def test_a_shared_beginning_is_split(spark):
    """A third of the words begin alike: halved intervals keep groups small."""
    words = ["internationalisation" + "".join(chr(97 + i // 26 ** k % 26) for k in range(3)) for i in range(0, 17576, 8)]
    rows = [(i, " ".join([w] * 5)) for i, w in enumerate(words)]
    assert run(spark, rows, limit=64, noise=1 << 40) == brute(rows, noise=1 << 40)


def test_query(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    got = QUERIES["op11_spelling_fst"](spark, D)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute([(r.doc_id, r.text) for r in docs.collect()])
