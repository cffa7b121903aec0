"""The corpus pipeline: documents through language ID, exact dedup, near dedup, mixing and BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsync.llm import bpe, exact_dedup, langid, minhash, mixing
from docsync.llm.common import materialize
from docsync.llm.queries import table, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any recognisable language go; the profiles are learned from the labelled ones."""
    return langid.keep_identified(docs, langid.learn_profiles(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return minhash.drop_near_copies(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask for."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, one row per document of the mix."""
    return bpe.bpe_digests(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("minhash_dedup", near_copies),
    ("source_mix", mix_sources),
    ("bpe", encode),
]

#: SQL expresses neither the language profiles nor the merges of the tokenizer; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
