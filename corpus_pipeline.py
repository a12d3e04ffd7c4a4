"""The corpus pipeline: STAGES in order, each written as Parquet and read again as the next one's documents.

A stage's output is in the shared folder, so a lost executor costs no more than the stage that runs; it is deleted when
the next stage's is complete. The last one stays for the caller.

Defined results: null and empty texts are scored, stay alone in the join, have no personal data, no words and so no place
in the mix; very long texts pass through whole; of equal rows one stays; ties go by doc_id and digests; an empty table
gives no rows; all stages but the last keep further columns, whatever their names.
"""

from __future__ import annotations

from plexus.llm import bpe, jaccard, mixing, pii, quality
from plexus.llm.common import discard, scratch, table
from pyspark.sql import DataFrame, SparkSession


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.representatives(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms."""
    return pii.pseudonymised(docs, counts=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.materialise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_classifier", accept_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The classifier and the tokenizer have no SQL form; tests/llm/test_pipeline.py holds the stages and the run against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
