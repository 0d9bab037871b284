import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from lodestar.llm import fim_swar as S
from lodestar.llm.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


def brute(key, text, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    x = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in S.SENTINELS):
        return (key, n, "plain", None, None, text)
    if h[3] % 100 < 50:
        return (key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_marks_rank_and_select():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 8, 9, 64, 1000):
        data = rng.choice(np.array([10, 9, 11, 138, 0, 255, 97], np.uint8), size)
        marks = S.Marks(S.mark_byte(S.as_words(data), 10))
        at = np.flatnonzero(data == 10)
        assert marks.position(np.arange(len(at))).tolist() == at.tolist()
        assert marks.before(np.arange(size + 1)).tolist() == [int((data[:i] == 10).sum()) for i in range(size + 1)]
        inner = S.Marks(S.mark_continuation(S.as_words(data)))
        assert inner.before(np.array([size]))[0] == ((data & 0xC0) == 0x80).sum()


def test_against_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "\n", "\n\n\n", "a", "é\nü", "x\r\ny", "<", "a<\n<P\n>", "holds <S>\nthis", "<M>", "😀\n" * 50, "line\n" * 3000 + "open",
             "one line " * 40_000, "<\nP>\n<\nS>"]
    rows = [(i, rng.choice(texts) if i % 2 else "".join(rng.choice(["ab", "\n", "ß", " ", "<", "P>"]) for _ in range(rng.randint(0, 30)))) for i in range(600)]
    rows += [(None, "a\nb\nc"), (None, None), (7, "a\nb"), (7, "a\nb")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n int, output string")
    got = S.rearranged(df, part_bytes=1 << 16)
    want = sorted((brute(*r) for r in rows), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    back = got.select("doc_id", S.restored(F.col("output"), F.col("form")).alias("t"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((k, t or "") for k, t in rows), key=repr)
    assert S.rearranged(df.filter("false")).count() == 0


def test_rates(spark):
    df = spark.createDataFrame([(i, "a\nb\nc\nd\n") for i in range(400)], "id long, body string")
    forms = [r.form for r in S.rearranged(df, "id", "body", fim_percent=50, spm_percent=0).collect()]
    assert set(forms) == {"plain", "psm"} and 120 < forms.count("plain") < 280


def test_a_long_text(spark):
    df = spark.range(1).select("id", F.repeat(F.lit("fünf Wörter sind eine Zeile\n"), 1_000_000).alias("text"))
    r = S.rearranged(df, "id").select("n", "prefix_chars", "middle_chars", F.sha2(S.restored(F.col("output"), F.col("form")), 256).alias("s")).first()
    text = "fünf Wörter sind eine Zeile\n" * 1_000_000
    assert r.n == 1_000_000 and r.s == hashlib.sha256(text.encode()).hexdigest() and r.prefix_chars % 28 == 0


def test_oracle(spark):
    import duckdb

    duckdb.sql(f"create or replace view documents as select * from '{D}/documents.parquet'")
    want = duckdb.sql(ORACLES["op12_fim_swar"])
    got = QUERIES["op12_fim_swar"](spark, D).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
