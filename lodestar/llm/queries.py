"""Queries of the corpus operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import byte_bpe, context_mixing
from lodestar.llm.co_training import quality
from lodestar.llm.common import documents, table
from lodestar.llm.extendible_dedup import exact_groups
from lodestar.llm.fair_mixing import fair_mix
from lodestar.llm.fim_swar import rearranged, restored
from lodestar.llm.fm_substring import substring_dedup
from lodestar.llm.hilbert_packing import packed
from lodestar.llm.nb_linear_toxicity import toxicity
from lodestar.llm.posting_lists import nearest
from lodestar.llm.simhash_vptree import near_duplicates
from lodestar.llm.spelling_fst import variants
from lodestar.llm.token_counts import token_counts


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "text")
    return exact_groups(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def q_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix(documents(spark, sf_dir))


def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN)


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def q_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", spans.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def q_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def q_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(documents(spark, sf_dir), online=True)


def q_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def q_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))


def q_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rearranged(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_token_counts": q_token_counts,
    "op2_co_training": q_co_training,
    "op3_fair_mixing": q_fair_mixing,
    "op4_simhash_vptree": q_simhash,
    "op5_fm_substring": q_substring_dedup,
    "op6_exact_dedup": q_exact_dedup,
    "op7_context_mixing": q_context_mixing,
    "op8_byte_bpe": q_byte_bpe,
    "op9_posting_lists": q_posting_lists,
    "op10_nb_linear_toxicity": q_toxicity,
    "op11_spelling_fst": q_spelling,
    "op12_fim_swar": q_fim,
    "op13_hilbert_packing": q_packing,
}

ORACLES: dict[str, str] = {
    "op5_fm_substring": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS s FROM d),
        windows AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS seq FROM starts),
        firsts AS (SELECT seq, min(doc_id) AS least FROM windows GROUP BY seq),
        hits AS (SELECT doc_id, s FROM windows JOIN firsts USING (seq) WHERE doc_id > least),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM hits),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
                 FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_fim_swar": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
        h AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, len(u) AS n,
                     CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
                     CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
        cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                       CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
                            THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
        parts AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
                         array_to_string(u[b + 1:n], '') AS s FROM cut)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
        FROM parts""",
}
