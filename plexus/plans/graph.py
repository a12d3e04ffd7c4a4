"""The property graph: nodes and edges as DataFrames."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

import plexus
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this package travel with the task, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(plexus)

#: Node labels and their key property; None: the label has no unique key. Fixed values.
LABEL_KEYS = {
    "Project": "name", "Package": "qualified_name", "Folder": "path", "File": "path", "Module": "qualified_name", "Class": "qualified_name", "Function": "qualified_name", "Method": "qualified_name",
    "Interface": None, "Enum": None, "Type": None, "Union": None, "ModuleInterface": None, "ModuleImplementation": None, "ExternalPackage": "name",
}
#: Edge types, fixed values.
EDGE_TYPES = ("CONTAINS_PACKAGE", "CONTAINS_FOLDER", "CONTAINS_FILE", "CONTAINS_MODULE", "DEFINES", "DEFINES_METHOD", "IMPORTS", "EXPORTS", "EXPORTS_MODULE", "IMPLEMENTS_MODULE", "INHERITS", "IMPLEMENTS", "OVERRIDES", "CALLS", "DEPENDS_ON_EXTERNAL")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one in local mode only, as other executors could not read it."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at and not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    at = at or "file://" + tempfile.mkdtemp(prefix="plexus-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder in the shared one that nothing else uses."""
    return f"{shared_dir(spark)}/plexus-{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cuts lineage with a checkpoint in the cluster's shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cuts lineage as ``durable`` does, with Parquet in the shared folder, of which each reader takes only the columns that it names."""
    at = new_folder(df.sparkSession, "rows")
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def large(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the corpus: both sides are sorted and merged, and this one is never broadcast.

    Rows made from a small table, such as sources from a list of numbers, look as small as that table after any number of
    checkpoints, so Spark would gather millions of them on the driver.
    """
    return df.hint("merge")


def met(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A merged join on long names that begin alike: they are sorted by a hash first, which tells nearly all of them apart."""
    key = F.xxhash64(*on)
    return left.withColumn("_h", key).join(large(right.withColumn("_h", key)), ["_h", *on], how).drop("_h")


def spread(df: DataFrame) -> DataFrame:
    """Rows that each cost much, such as sources to parse, over all cores where a small input has fewer partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class PropertyGraph:
    """nodes: node_id, label and properties. edges: src, dst, type and properties."""

    nodes: DataFrame
    edges: DataFrame

    def label(self, *labels: str) -> DataFrame:
        return self.nodes.filter(F.col("label").isin(*labels))

    def of_type(self, *types: str) -> DataFrame:
        return self.edges.filter(F.col("type").isin(*types))

    def undirected(self, *types: str) -> DataFrame:
        """src, dst, type with every edge in both directions; a self-loop twice."""
        e = (self.of_type(*types) if types else self.edges).select("src", "dst", "type")
        return e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type"))

    def ends(self, *types: str, src: tuple[str, ...] = (), dst: tuple[str, ...] = ()) -> DataFrame:
        """Edges with their ends' properties as s_<name> and d_<name>, optionally of given labels."""
        e = self.of_type(*types) if types else self.edges
        for end, labels, tag in (("src", src, "s_"), ("dst", dst, "d_")):
            n = self.label(*labels) if labels else self.nodes
            n = n.select(*[F.col(c).alias(tag + c) for c in n.columns])
            e = e.join(n, F.col(end) == F.col(tag + "node_id"))
        return e

    def degrees(self, *types: str) -> DataFrame:
        """node_id, n_in, n_out by edge multiplicity, in one aggregation."""
        e = self.of_type(*types) if types else self.edges
        sides = e.select(F.col("src").alias("node_id"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(e.select("dst", F.lit(0), F.lit(1)))
        return sides.groupBy("node_id").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))


def production(qn: Column, mark: str = "test") -> Column:
    """Whether a qualified name is production code: it does not contain ``mark``; null is not."""
    return F.coalesce(~F.lower(qn).contains(mark), F.lit(False))


def module_of(qn: Column, prefix: str = "", depth: int = 1) -> Column:
    """The first ``depth`` dotted parts after all occurrences of ``prefix`` are taken out."""
    rest = F.replace(qn, F.lit(prefix), F.lit("")) if prefix else qn
    return F.substring_index(rest, ".", depth)
