"""A corpus pipeline of five operators: quality, language, near-duplicates, decontamination, tokens.

Each stage takes what its predecessor kept, as a table, and all but the last return the columns of `documents`.
Rows are told apart by id and text, so repeated ids do no harm; columns a stage does not know go through. A null or
empty text fails the quality rules, a very long one is read whole, an empty table stays one; rows equal in id and text
share their fate, but for near-duplicates, of which one row stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmeld.llm import bpe, decontam, langid, quality, simhash
from jobmeld.llm.common import stored, without

LEAST_SCORE = 0.5  # a language less probable or less fitting than that is none


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, and the strict ones unless their source fails less often than all for sure."""
    rejected = quality.judge(docs).filter(~F.col("kept"))
    return without(docs, rejected, "doc_id", "text", "source")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the learnt languages."""
    rejected = langid.identify(docs).filter((F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < LEAST_SCORE))
    return without(docs, rejected, "doc_id", "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return simhash.one_of_each(docs, simhash.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are words of benchmark passages."""
    found = decontam.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.filter(decontam.contaminated()), "doc_id", "text")


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_tokens", bpe_tokens),
]

# naive Bayes, the fingerprint's hash and the vocabulary's merges are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
