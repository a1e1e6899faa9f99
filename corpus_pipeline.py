"""The corpus pipeline: language identification, exact and near de-duplication, mixing, encoding.

Each stage takes (spark, documents, sf_dir) and returns a frame. All stages but the last return the columns of
their documents. Mixing adds ``training_position``, the order of the curriculum, which stored files do not keep;
the last stage carries it on. That stage returns, per taken copy, doc_id, training_position, n_tokens, the ids
and hashes of ids and of the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitals.llm import bpe, exact_dedup, language, mixing, simhash
from vitals.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; a text that the fused evidence rejects goes."""
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest doc_id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link, that with the smallest doc_id."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once per time taken, in the order of training."""
    return mixing.curriculum(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every copy, with its place in training; hashes of ids and decoded text."""
    return bpe.encode_digests(docs, keep=[c for c in docs.columns if c == mixing.POSITION], with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Trigram models and word merges are beyond SQL; a brute-force version checks the pipeline in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
