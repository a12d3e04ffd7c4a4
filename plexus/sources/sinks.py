"""Writes to a graph: upserts by key, reports of unresolved ends, JSON output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.operators.sampling import numbered
from plexus.plans.graph import LABEL_KEYS


def acceptable(batch: DataFrame) -> DataFrame:
    """Rows whose label has a unique key that the row gives; others are skipped, as on insertion."""
    return batch.filter(F.col("label").isin(*[k for k, v in LABEL_KEYS.items() if v]) & F.col("key").isNotNull())


def merged_nodes(batch: DataFrame) -> DataFrame:
    """Label, key, props of batch (label, key, props map, seq): the last value of each property wins, null removes it.

    Properties are aggregated one by one with partial sums, so a node written many times is no large group.
    """
    own = acceptable(batch)
    every = own.select("label", "key").distinct()
    values = own.select("label", "key", "seq", F.explode("props").alias("k", "v"))
    last = values.groupBy("label", "key", "k").agg(F.max_by("v", "seq").alias("v")).filter("v IS NOT NULL")
    maps = last.groupBy("label", "key").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("props"))
    return every.join(maps, ["label", "key"], "left").withColumn("props", F.coalesce("props", F.create_map().cast("map<string,string>")))


def resolved_edges(specs: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(src, dst, type once each, specs with an end that no node has).

    specs: from_label, from_key, type, to_label, to_key; nodes: node_id, label, key, unique by label and key.
    """
    end = lambda side, out: nodes.select(F.col("label").alias(f"{side}_label"), F.col("key").alias(f"{side}_key"), F.col("node_id").alias(out))
    joined = specs.join(end("from", "src"), ["from_label", "from_key"], "left").join(end("to", "dst"), ["to_label", "to_key"], "left")
    both = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return joined.filter(both).select("src", "dst", "type").distinct(), joined.filter(~both).select(specs.columns)


def failed_report(specs: DataFrame, lost: DataFrame) -> DataFrame:
    """Type, attempted, failed of types with failures."""
    tried = specs.groupBy("type").agg(F.count("*").alias("attempted"))
    return tried.join(lost.groupBy("type").agg(F.count("*").alias("failed")), "type")


def first_nodes(batch: DataFrame) -> DataFrame:
    """node_id from 0 in order of arrival, label, key, props; the first write of a key stays."""
    first = batch.groupBy("label", "key").agg(F.min_by(F.struct("seq", "props"), "seq").alias("f")).select("label", "key", "f.*")
    return numbered(first, ["seq", "label", "key"], "node_id", "").drop("seq")


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, at: str) -> None:
    """Folders of JSON lines: nodes, relationships and metadata; ``at`` is the time stamp.

    nodes: node_id, labels, properties; edges: from_id, to_id, type, properties. Nothing comes to the driver.
    """
    nodes.write.mode("overwrite").json(f"{path}/nodes")
    edges.write.mode("overwrite").json(f"{path}/relationships")
    spark = nodes.sparkSession
    counts = [spark.read.schema("type string").json(f"{path}/{d}").agg(F.count("*").alias(c)) for d, c in (("nodes", "total_nodes"), ("relationships", "total_relationships"))]
    counts[0].crossJoin(counts[1]).withColumn("exported_at", F.lit(at)).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")  # one row


def truncate(like: DataFrame, path: str) -> None:
    """An empty table of the same columns."""
    like.limit(0).write.mode("overwrite").parquet(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """A folder of JSON lines, one a row, nulls included: node texts, prompts, evaluation prompts or questions."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)
