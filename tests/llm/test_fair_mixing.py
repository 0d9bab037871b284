import random
import re

from lodestar.llm.fair_mixing import fair_mix, mixed_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Hand out by weight; what is above the cap goes round again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    got, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        each = left / sum(w[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            got[s] += each * w[s]
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = float(most * sizes[s])
                open_.discard(s)
    return got


def check(spark, rows, packet=16):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = fair_mix(df, packet=packet).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, fair_mix(df, packet=packet).collect()), key=repr)
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, _x in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = targets(sizes)
    by = {r[0]: r[2] for r in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = by[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * packet, (s, taken[s], want[s])
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 1


def test_against_the_definition(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        s = rng.choice(["a", "hot", "hot", "hot", None, "Z", "é", "\U0001f600", "zero"])
        n = 0 if s == "zero" else rng.choice([0, 1, 5, 40, 300]) if s != "Z" else 3
        rows.append((i, rng.choice([" ", "\n", "\t ", "  "]).join(["w"] * n) if rng.random() > .02 else None, s, "x"))
    rows.append((9999, "w " * 9000, "a", "x"))  # one very long document
    check(spark, rows)


def test_small_and_empty_tables(spark):
    check(spark, [(1, "one two", "s", None)])
    check(spark, [(1, None, None, None), (2, "", None, None)])
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert fair_mix(df).count() == 0


def test_carried_columns_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c", "s", 5), (1, "a b c", "s", 5), (2, "d", "t", 6)],
                               "doc_id long, text string, source string, target int")
    got = fair_mix(df.withColumnRenamed("target", "extra"), carry=["extra"]).collect()
    assert sorted((r.doc_id, r.extra, r["size"]) for r in got) == [(1, 5, 3), (1, 5, 3), (2, 6, 1)]


def test_mixed_rows(spark):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(i % 30)) + "\n", ["a", "b", None, "c"][i % 4]) for i in range(200)]
    rows.append((500, "x  y " * 2000, "a"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r.doc_id: (r.taken, r["size"]) for r in fair_mix(df, packet=8).collect()}
    got = mixed_rows(df, packet=8)
    assert got.columns == df.columns
    words, texts = {}, dict((i, t) for i, t, _ in rows)
    for r in got.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.text == texts[r.doc_id] or texts[r.doc_id].split()[:len(r.text.split())] == r.text.split()
    assert words == {k: t for k, (t, _) in taken.items() if t}


def test_mixed_rows_lose_no_word_and_no_column(spark):
    """Repeated rows share all that is taken; columns may be named like helpers."""
    rows = [(7, "a b c d e", "s", i % 2, 10, "x", "y") for i in range(9)] + [(8, "p q r", "t", 0, 11, None, "z")] * 3 + [(None, "n o", None, 5, 6, "u", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _a int, _size int, _copy string, copy string")
    for packet in (2, 256):
        taken = sum(r.taken for r in fair_mix(df, packet=packet).collect())
        got = mixed_rows(df, packet=packet)
        assert got.columns == df.columns
        got = got.collect()
        assert sum(len(r.text.split()) for r in got) == taken
        assert {tuple(r)[2:] for r in got} <= {r[2:] for r in rows}
        assert {r._a for r in got if r.doc_id == 7} == {0, 1}
