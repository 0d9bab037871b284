import public_tokenizers
import pytest

from lodestar.llm.token_counts import token_counts

TEXTS = [None, "", " ", "it's we'll  go  on\n\n\tnow", "a<|endoftext|>b <|endoftext|>", "x" * 3000,
         "　 　a   b", "café à la\u0085 x", "word " * 4000, "  lead", "trail  ", "word " * 4000,
         "\U0001f600 \U0001f601‍ 1234 12a b34"]


@pytest.mark.parametrize("part_bytes", [64, 1 << 20])
def test_counts_match_the_library(spark, part_bytes):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in token_counts(df, path, part_bytes=part_bytes, call_bytes=32).collect()}
    for i, t in enumerate(TEXTS):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512), t


def test_other_models_and_empty_table(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r.doc_id: r.n_tokens for r in token_counts(df, path).collect()} == {
        i: len(sp.encode(t or "")) for i, t in enumerate(TEXTS)}
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    assert {r.doc_id: r.n_tokens for r in token_counts(df, path).collect()} == {
        i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    assert token_counts(df.filter("false"), path).count() == 0
