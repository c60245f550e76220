"""A training corpus from raw documents, stage by stage.

Each stage's result is written as Parquet and read again as the next one's
input, so a lost executor costs one stage at most.
"""

from pyspark.sql import DataFrame, SparkSession

from txnrisk.llm import language_id, length_packing, secret_scan, simhash
from txnrisk.llm.tables import read, stored

#: Documents whose language is recognised with a smaller probability go.
LEAST_PROBABILITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    return language_id.accepted(docs, language_id.fit(docs), LEAST_PROBABILITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs, words=4, radius=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, with their ids, from buckets of equal length."""
    return length_packing.bucketed(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

# Trained models, hashes of shingles and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
