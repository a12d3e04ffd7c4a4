"""What the corpus operators share: table access, the shared folder, word patterns, hot-group helpers."""

from __future__ import annotations

import gc
import re
import sys
import tempfile
import uuid

import plexus
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this package travel with the task, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(plexus)
if "corpus_pipeline" in sys.modules:
    cloudpickle.register_pickle_by_value(sys.modules["corpus_pipeline"])

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows and bytes of an Arrow batch at most, so that a worker holds few long texts at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Texts are long rows: the default of 10,000 rows a batch lets a worker's memory grow with them.

    Spark reads these settings when a plan runs, which is after the query has returned it, so they stay set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it is unset: a temporary one in local mode, else an error."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at and not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not at:
        at = "file://" + tempfile.mkdtemp(prefix="plexus-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/plexus-{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this session wrote."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage; the rows are in the shared folder, so they outlive any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more, instead of at some later collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in order; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
