"""A corpus pipeline of five stages, each of which works on all that the one before it kept.

Language ID drops documents without an identifiable language, exact dedup keeps one of equal texts, near-deduplication keeps one of
each group of texts that SimHash fingerprints of five-word shingles bring together and whose sets of shingles have a
similarity of at least 0.8, decontamination drops documents that hold a benchmark item, and best-fit packing lays out what is left.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litquarry.llm import decontaminate, exact_dedup, language_id, packing, simhash_similar
from litquarry.llm.common import fresh_path, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def distinct_shingles(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_similar.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identified),
    ("exact_dedup", distinct_texts),
    ("simhash_dedup", distinct_shingles),
    ("decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

#: Fingerprints and classifiers are beyond SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; between stages documents are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
