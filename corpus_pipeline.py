"""Cleaning a corpus in stages: toxic documents go, then those in no known language, then repeated lines,
then near-duplicates, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ballstats.llm import common, jaccard_join, language_id, line_dedup, packing, toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents it gets and their labels outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.kept(docs, toxicity.fit(docs, labels))


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.kept(docs, language_id.fit(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the smallest id stays."""
    return jaccard_join.representatives(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("toxicity", without_toxic), ("language ID", in_a_language), ("line dedup", without_repeated_lines)]
STAGES += [("n-gram Jaccard join", without_near_duplicates), ("packing", packed)]

# Stages that learn, tokenize or join by edits cannot be written as SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
