"""The corpus pipeline: toxic documents go, one of each group of near-duplicates
stays, documents with benchmark items go, secrets are masked, and the sources are mixed to target weights.

A stage takes (spark, docs, sf_dir); all but the last return the columns of
documents.  ``run`` writes what a stage returns and rereads it for the next; the table
of a stage is deleted once the next has been written.

Null and empty texts are not toxic, like no other text, contain no item and no secret, and
are mixed with size 0.  Rows with a null doc_id are judged by their texts alone and aren't
compared with others.  Of rows that repeat a doc_id one stays after the second stage.  An
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import decontaminate, mixing, neardup, secret_scan, toxicity
from chatloom.llm.common import discard, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; the model learns from the labels of the documents that are there."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the smallest doc_id."""
    return neardup.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (0.8 of its five-word shingles)."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every document that is left."""
    return mixing.mix_sources(docs)


STAGES = [("toxicity", without_toxic), ("near-dedup", deduplicated), ("decontamination", decontaminated), ("secrets", masked), ("mixing", mixed)]

#: Trained models and near-duplicate groups can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
