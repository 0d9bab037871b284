import hashlib
import struct

import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from lodestar.llm.byte_bpe import Vocabulary
from lodestar.llm.fair_mixing import WORD
from lodestar.llm.nb_linear_toxicity import toxicity
from tests.llm.test_fair_mixing import targets
from tests.llm.test_simhash_vptree import classes, simhash

D = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    import re

    docs = spark.read.parquet(f"{D}/documents.parquet")
    all_rows = {r.doc_id: r for r in docs.collect()}
    rejected = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{D}/labels.parquet")).collect() if r.predicted}
    after = []
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == list(docs.columns), name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        after.append([r.doc_id for r in docs.collect()])
    clean = set(all_rows) - rejected
    assert sorted(after[0]) == sorted(clean)
    top = {}
    for k in clean:
        top[all_rows[k].text] = max(k, top.get(all_rows[k].text, k))
    assert sorted(after[1]) == sorted(top.values())
    ids = sorted(top.values())
    assert sorted(after[2]) == sorted(set(classes(ids, [simhash(all_rows[k].text) for k in ids])))
    words = lambda t: len(re.findall(WORD, t or ""))
    sizes = {}
    for k in after[2]:
        sizes[all_rows[k].source] = sizes.get(all_rows[k].source, 0) + words(all_rows[k].text)
    want, got = targets(sizes), dict.fromkeys(sizes, 0)
    for r in docs.collect():
        got[r.source] += words(r.text)
    assert all(abs(got[s] - want[s]) <= 512 for s in sizes)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=Vocabulary(P.path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    coded = C.encode_tokens(spark, docs, D)
    expect = []
    for r in docs.collect():
        ids = lib.encode_ordinary(r.text)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expect.append((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest(), packed))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in coded.collect()) == sorted(expect)


def test_run_and_registration(spark):
    import __spark_entry__ as E

    assert E.queries()["pipeline"](spark, D).count() > 0
    assert [n for n, _ in C.STAGES] and all(f"op{i}_" in " ".join(E.queries()) for i in (1, 3, 4, 6, 8, 10))
