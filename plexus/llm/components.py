"""Connected components of large graphs by repeated joins; no group of vertices meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import checkpoint


def roots(pointers: DataFrame, columns: list[str]) -> DataFrame:
    """``pointers`` (v and, per column, a v that is not larger) with every pointer followed to its end by doubling."""
    now = checkpoint(pointers)
    while True:
        step = now
        for c in columns:
            step = step.join(now.select(F.col("v").alias(c), F.col(c).alias("_far")), c).drop(c).withColumnRenamed("_far", c)
        step = checkpoint(step.select(*pointers.columns))
        moved = F.lit(False)
        for c in columns:
            moved = moved | (F.col(f"n.{c}") != F.col(f"s.{c}"))
        if step.alias("s").join(now.alias("n"), F.col("s.v") == F.col("n.v")).filter(moved).isEmpty():
            return step
        now = step


def components(edges: DataFrame) -> DataFrame:
    """v and label, the least vertex reachable, for each vertex of ``edges`` (a, b).

    Each round replaces edges by their ends' current labels, every label takes the least of its neighbours' labels, and
    pointers are doubled until they rest; the least label of a component at least halves the others each round.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    labels = checkpoint(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    labels = roots(labels, ["label"])
    while True:
        ends = edges.join(labels.select(F.col("v").alias("a"), F.col("label").alias("la")), "a").join(labels.select(F.col("v").alias("b"), F.col("label").alias("lb")), "b")
        open_edges = checkpoint(ends.filter("la != lb").select("la", "lb").distinct())
        if open_edges.isEmpty():
            return labels
        least = open_edges.select(F.greatest("la", "lb").alias("label"), F.least("la", "lb").alias("_to")).groupBy("label").agg(F.min("_to").alias("_to"))
        moved = labels.join(least, "label", "left").select("v", F.coalesce("_to", "label").alias("label"))
        labels = roots(moved, ["label"])
