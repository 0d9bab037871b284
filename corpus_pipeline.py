"""Corpus pipeline: documents -> clean, unique, mixed, encoded documents.

``run`` applies ``STAGES`` in order. Each stage reads what the one before it
wrote as Parquet below spark.checkpoint.dir, so a lost executor repeats at
most one stage, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import byte_bpe, extendible_dedup, fair_mixing, nb_linear_toxicity, simhash_vptree
from lodestar.llm.common import documents, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    return nb_linear_toxicity.clean_rows(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (the largest id)."""
    return extendible_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (the smallest id)."""
    return simhash_vptree.kept_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by target weight, a row per copy taken."""
    return fair_mixing.mixed_rows(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the decoded bytes."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                               keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_tokens),
]

#: SQL can't express the classifier, the fingerprints or the encoding; tests/llm
#: holds each stage and the whole run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
