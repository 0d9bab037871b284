import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestar.llm import hilbert_packing as H
from lodestar.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
D = "/root/testdata/sf0.001"


def check(pieces, rows, length=2048):
    """Pieces (key, start, length, ids, doc_tokens, sequence_id, offset) hold
    every id of the rows once, in whole sequences."""
    tok = Tokenizer.from_file(PATH)
    want = sorted((repr(k), tuple([*tok.encode(t or "", add_special_tokens=False).ids, 1])) for k, t in rows)
    by_seq, total = {}, 0
    for r in pieces:
        assert len(r.ids) == 4 * r.length > 0
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    full = 0
    for s in by_seq.values():
        end = 0
        for offset, n in sorted(s):
            assert offset == end
            end += n
        assert end == length or end & (end - 1) == 0
        full += end == length
    assert total == sum(len(x) for _, x in want) and full >= total // length
    assert sorted(by_seq) == list(range(len(by_seq)))
    if len({k for k, _ in rows}) == len(rows):
        docs = {}
        for r in sorted(pieces, key=lambda r: r.start):
            ids = docs.setdefault(repr(r.doc_id), [])
            assert r.start == len(ids)
            ids += np.frombuffer(r.ids, "<u4").tolist()
            assert r.doc_tokens >= len(ids)
        assert sorted((k, tuple(v)) for k, v in docs.items()) == want
    else:
        assert sorted(i for r in pieces for i in np.frombuffer(r.ids, "<u4").tolist()) == sorted(i for _, x in want for i in x)


def test_odd_rows(spark):
    odd = [None, "", " ", "a", "Ångström ÅÅ", "it's o'clock' 's", "x § y ¤ § §§", "<|endoftext|>a <|startoftext|>", "1234 5,6",
           "Σίσυφος ΟΔΟΣ ΟΔΟΣ", "　中文 字\x85z", "a\x1cb \x0b\x0c", "😀😀 ‡†", "word " * 3000, "🙂" * 2000, "á ́b é"]
    rows = [(i, odd[i % len(odd)]) for i in range(64)] + [(None, "null id")]
    df = spark.createDataFrame([(k, t, 5, "z") for k, t in rows], "doc_id long, text string, length int, place string")
    got = H.packed(df, PATH).collect()
    check(got, rows)
    plain = H.packed(df, PATH, length=64, powers=False).collect()
    by_seq = {}
    for r in plain:
        by_seq[r.sequence_id] = by_seq.get(r.sequence_id, 0) + r.length
    assert sorted(by_seq.values())[1:] == [64] * (len(by_seq) - 1)
    assert H.packed(df.filter("false"), PATH).count() == 0
    check(H.packed(df.unionAll(df), PATH).collect(), rows + rows)


def test_long_text_in_pieces(spark, monkeypatch):
    text = "naïve Köder, 12 o'clock\n" * 4000
    monkeypatch.setattr(H, "PART_BYTES", 5000)
    e = H.Encoder(PATH)
    data = np.frombuffer(text.encode(), np.uint8)
    ids, ends = e.texts(np.array([0, len(data)]), data)
    assert ids.tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids and ends.tolist() == [len(ids)]


def test_other_tokenizers_see_whole_texts():
    e = H.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    data = np.frombuffer(b"two words  here", np.uint8)
    ids, _ = e.texts(np.array([0, len(data)]), data)
    assert not e.by_word and ids.tolist() == e.plain("two words  here")


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = H.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(1 << bits * dims))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_are_alike(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").filter("text is not null").dropDuplicates(["text"])
    lang = {r.doc_id: r.lang for r in docs.collect()}
    order = [r.doc_id for r in H.packed(docs, PATH).orderBy("sequence_id", "offset").collect()]
    same = np.mean([lang[a] == lang[b] for a, b in zip(order, order[1:], strict=False) if a != b])
    by_id = sorted(lang)
    chance = np.mean([lang[a] == lang[b] for a, b in zip(by_id, by_id[1:], strict=False)])
    assert same > chance + 0.1


def test_query(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    whole = H.packed(docs, PATH)
    check(whole.collect(), rows)
    got = QUERIES["op13_hilbert_packing"](spark, D)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    tok = Tokenizer.from_file(PATH)
    ids = {k: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for k, t in rows}
    for r in got.collect():
        own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    twice = [sorted(map(tuple, QUERIES["op13_hilbert_packing"](spark, D).collect())) for _ in range(2)]
    assert twice[0] == twice[1]


def test_a_hot_text_is_spread(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "the same words here").otherwise(F.concat(F.lit("number "), "id")).alias("text"))
    rows = H.encoded(df, PATH, "doc_id", "text", 1, 13).filter("key % 2 = 0")
    assert rows.select("curve").distinct().count() == 1 and rows.select("place").distinct().count() > 1000
