import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken

from lodestar.llm import byte_bpe as B

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary(RANKS)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_pieces(vocabulary, library):
    rng = random.Random(1)
    pieces = ["".join(rng.choice("aeinorst éß日\U0001f600!'0") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    pieces += ["a" * 700, "ab" * 333, " " * 500, "=" * 77, "x"]
    got = vocabulary.encode_pieces([p.encode() for p in pieces])
    for p, ids in zip(pieces, got, strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library._encode_single_piece(p.encode()), p


def texts():
    rng = random.Random(2)
    alphabet = ["a", "the", " ", "  ", "\n", "'s", "'ll", "!", "...", "12", "é", "　", " ", "日本", "\U0001f600", "\t "]
    out = [None, "", " ", "   x", "<|endoftext|> a", "z" * 300, " " * 300, "a" * 100 + " b"]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(400)]


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 1 << 12), (40, 25), (7, 5)])
def test_round_trip(spark, library, chunk, overlap):
    rows = [(i % 390, t, "x") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = B.round_trip(df, RANKS, P.PATTERN, chunk=chunk, overlap=overlap).collect()
    want = []
    for k, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.round_trip(df, RANKS, P.PATTERN).count() == 0
