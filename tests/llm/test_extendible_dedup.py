import hashlib
import random

from lodestar.llm import extendible_dedup as X


def brute(rows):
    groups = {}
    for k, t in rows:
        groups.setdefault(t or "", []).append(k)
    out = []
    for k, t in rows:
        ids = groups[t or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((k, keep, len(ids), k == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, group_size int")
    return sorted(map(tuple, X.exact_groups(df, **more).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, "", " ", "a", "A", "é", "x" * 50_000, f"t{i % 97}", f"u{i}"])) for i in range(3000)]
    rows += [(5000, "dup"), (5000, "dup"), (None, "dup"), (None, "lonely")]
    assert run(spark, rows, bucket_entries=4) == brute(rows)
    assert run(spark, []) == []


def test_colliding_hashes_chain_and_split(spark):
    table = X.ExtendibleTable(2)
    for h in range(64):
        table.chain(h).append(h)
        table.added(h)
    for _ in range(9):  # one hash can't be split: its chain grows
        table.chain(3).append("again")
        table.added(3)
    assert table.depth >= 5 and len(table.directory) == 1 << table.depth
    for slot, bucket in enumerate(table.directory):
        assert slot & ((1 << bucket["depth"]) - 1) == bucket["prefix"]
    assert sorted(len(c) for b in table.buckets() for c in b["chains"].values()) == [1] * 63 + [10]


def test_kept_rows(spark):
    df = spark.createDataFrame([(1, "a", "s"), (2, "a", None), (2, "a", None), (3, None, "s"), (4, "", "t")],
                               "doc_id long, text string, kept string")
    got = sorted(map(tuple, X.kept_rows(df).collect()))
    assert got == [(2, "a", None), (4, "", "t")]


def test_oracle(spark):
    import duckdb

    from lodestar.llm.queries import ORACLES, QUERIES

    d = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view documents as select * from '{d}/documents.parquet'")
    want = duckdb.sql(ORACLES["op6_exact_dedup"])
    got = QUERIES["op6_exact_dedup"](spark, d).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
