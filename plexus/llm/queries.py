"""The registered queries of the corpus operators, and the SQL of those that SQL expresses."""

from __future__ import annotations

from functools import reduce

import corpus_pipeline
from plexus.llm import align, bpe, centroids, fingerprints, jaccard, langid, mixing, pii, quality, rules, tokencount, urls, warc
from plexus.llm.common import scratch, shared_dir, table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_values", "kinds")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/plexus-token-counts")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.train(spark))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


def rules_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy removes, from the same ledger."""
    rows = rules.written(table(spark, sf_dir, "documents"), scratch(spark, "ledger"))
    parts = [rules.ablation(rows, p).select(F.lit(p).alias("policy"), "*") for p in rules.POLICIES]
    return reduce(DataFrame.unionByName, parts)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text", "source")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("target_uri")


QUERIES = {f.__name__: f for f in (op1_bpe, op2_pii, op3_fingerprints, op4_token_counts, op5_url_filter, op6_quality_rules, op7_ngram_jaccard, op8_language_id, op9_quality_classifier, op10_mixing, op11_centroids, op12_alignment, op13_warc, rules_ablation)}
QUERIES["pipeline"] = corpus_pipeline.run

SQL: dict[str, str] = {"op6_quality_rules": rules.sql(), "op10_mixing": mixing.sql(), "op11_centroids": centroids.sql(), "op13_warc": warc.SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
