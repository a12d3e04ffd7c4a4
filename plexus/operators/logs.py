"""Analytics of command logs: rows of cmd, repo, stderr, return_code, duration_ms, cached."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexus.functions.names import command_prefix, normal_error, pattern_id
from plexus.sources.tables import read


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select("event_id", "ts", F.col("user_id").cast("string").alias("repo"), F.col("event_type").alias("cmd"), (F.col("event_type") == "error").cast("int").alias("return_code"), F.col("value").alias("duration_ms"), (k % 2 == 0).alias("cached"))


def by_status(log: DataFrame, status: str) -> DataFrame:
    """Success, failed or cached; any other status has no rows."""
    tests = {"success": F.col("return_code") == 0, "failed": F.col("return_code") != 0, "cached": F.col("cached")}
    return log.filter(tests.get(status, F.lit(False)))


def _counts() -> list:
    real = ~F.col("cached")
    return [
        F.count("*").alias("total"), F.count_if(F.col("return_code") == 0).alias("success"), F.count_if(F.col("return_code") != 0).alias("failed"), F.count_if("cached").alias("cached"),
        F.coalesce(F.avg(F.when(real, F.col("duration_ms"))), F.lit(0.0)).alias("avg_ms"),
    ]


def summary(log: DataFrame) -> DataFrame:
    """A21/A22 in one row; the average leaves out cached results."""
    return log.agg(*_counts(), F.count_distinct("repo").alias("repos"), F.count_distinct("cmd").alias("cmds"))


def by_prefix(log: DataFrame) -> DataFrame:
    """Exact, whatever the number of prefixes."""
    out = log.groupBy(command_prefix(F.col("cmd")).alias("prefix")).agg(*_counts())
    return out.withColumn("failure_rate", F.col("failed") / F.col("total"))


def error_patterns(errors: DataFrame, examples: int = 3) -> DataFrame:
    """Errors (stderr, cmd, repo, seq) by normalised text: count, first texts and up to three examples by seq.

    Examples are picked by a row number inside the pattern, so no list of all of them is ever built.
    """
    norm = errors.withColumn("pattern", normal_error(F.col("stderr"))).withColumn("pattern_id", pattern_id(F.col("pattern")))
    counted = norm.groupBy("pattern_id", "pattern").agg(F.count("*").alias("n"), F.min_by(F.substring("stderr", 1, 500), "seq").alias("first_stderr"))
    w = Window.partitionBy("pattern_id").orderBy("seq")
    some = norm.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= examples)
    shown = some.groupBy("pattern_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "repo", "cmd"))), ",").alias("examples"))
    return counted.join(shown, "pattern_id")


def with_cache(commands: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answered from the cache by key, still to run)."""
    return commands.join(cache, "key"), commands.join(cache, "key", "left_anti")


def latest(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last write of each key."""
    values = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*values), seq).alias("_v")).select(key, "_v.*")


def moving_rate(log: DataFrame, points: int = 10) -> DataFrame:
    """W09 per repo: the mean duration over the last ``points`` results."""
    w = Window.partitionBy("repo").orderBy("event_id").rowsBetween(1 - points, 0)
    return log.select("event_id", "repo", F.avg("duration_ms").over(w).alias("moving_ms"))
