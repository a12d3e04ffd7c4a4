"""Structured Streaming jobs: command logs, file events, pending work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plexus.functions.names import has_prefix, normal_error, pattern_id
from plexus.operators.logs import by_prefix
from plexus.operators.paths import closure_delete
from plexus.plans.graph import PropertyGraph
from plexus.sources.files import RESULT, kept_path
from plexus.streaming.keyed import KeyedTable


def results(spark, path: str) -> DataFrame:
    """A stream of command results as their files arrive."""
    return spark.readStream.schema(RESULT).json(path)


def prefix_totals(log: DataFrame) -> DataFrame:
    """Exact totals by command prefix; the state store spills, so nothing is evicted."""
    return by_prefix(log)


def error_totals(log: DataFrame) -> DataFrame:
    """Exact counts by normalised error text, with the least example."""
    own = log.filter("return_code != 0 AND stderr != ''").withColumn("pattern", normal_error(F.col("stderr")))
    return own.groupBy(pattern_id(F.col("pattern")).alias("pattern_id"), "pattern").agg(F.count("*").alias("n"), F.min(F.substring("stderr", 1, 500)).alias("example"))


def rates(log: DataFrame, ts: str = "ts", size: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Results and failures by window of event time; rows later than ``late`` are dropped by the watermark."""
    out = log.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("return_code") != 0).alias("failed"))
    return out.select(F.col("w.start").alias("begin"), "n", "failed")


def latest_events(events: DataFrame) -> DataFrame:
    """Path, event_type: the last relevant event of each file; events: path, event_type, is_directory, ts."""
    own = events.filter(~F.col("is_directory") & kept_path(F.col("path")))
    return own.groupBy("path").agg(F.max_by("event_type", "ts").alias("event_type"))


def without_changed(g: PropertyGraph, changed: DataFrame) -> PropertyGraph:
    """The graph without the changed files' modules and what they contain, and without any call."""
    roots = g.label("Module").join(changed.select("path").distinct(), "path", "left_semi").select(F.col("node_id").alias("seed"))
    rest = closure_delete(g, roots)
    return PropertyGraph(rest.nodes, rest.edges.filter("type != 'CALLS'"))


def to_parse(changed: DataFrame) -> DataFrame:
    """Files that a change leaves in place."""
    return changed.filter(F.col("event_type").isin("modified", "created")).select("path")


def evicted(registry: DataFrame, module_qn: str) -> DataFrame:
    """A registry (qualified_name) without a module and its parts."""
    return registry.filter(~has_prefix(F.col("qualified_name"), module_qn))


def follow(events: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """``handle`` gets each micro-batch's last events by file; ``checkpoint`` makes a restart go on where it ended."""
    writer = events.writeStream.foreachBatch(lambda batch, n: handle(latest_events(batch), n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def pending(wanted: DataFrame, finished: DataFrame, key: str = "url") -> DataFrame:
    """What is neither completed nor failed yet."""
    return wanted.join(finished.select(key), key, "left_anti")


def run_once(rows: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what has arrived and gives its rows as written to ``path``; a restart with the same path goes on.

    ``complete`` rewrites the whole result with each micro-batch, as a changed total replaces the one before.
    """
    out, spark = f"{path}/rows", rows.sparkSession
    spark.createDataFrame([], rows.schema).write.mode("ignore").parquet(out)  # what is read if nothing has arrived
    if mode == "append":
        writer = rows.writeStream.format("parquet").option("path", out)
    else:
        writer = rows.writeStream.outputMode(mode).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
    writer.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


LIVE = "path string, ts struct<at:timestamp,id:bigint>, event_type string, names array<string>"


def live_modules(events: DataFrame, table: KeyedTable, checkpoint: str, parse: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Keeps ``table`` (of ``LIVE``, keyed by path) at what the files' last events leave: a deleted file has no names.

    Only files with new events are parsed again. An event that is older than what its file has seen changes nothing, in
    whatever micro-batch it comes. events: path, event_type, is_directory, ts. parse: path, names of given paths.
    """

    def prepare(batch: DataFrame) -> DataFrame:
        own = batch.filter(~F.col("is_directory") & kept_path(F.col("path")))
        return own.groupBy("path").agg(F.max(F.struct("ts", "event_type")).alias("b")).select("path", "b.ts", "b.event_type", F.lit(None).cast("array<string>").alias("names"))

    def combine(current: DataFrame, new: DataFrame) -> DataFrame:
        both = current.withColumn("_new", F.lit(False)).union(new.withColumn("_new", F.lit(True)))
        last = both.groupBy("path").agg(F.max_by(F.struct("ts", "event_type", "names", "_new"), F.struct("ts", ~F.col("_new"))).alias("b")).select("path", "b.*")
        asked = last.filter("_new AND event_type != 'deleted'")
        parsed = asked.drop("names").join(parse(asked.select("path")), "path", "left").select("path", "ts", "event_type", F.coalesce("names", F.array().cast("array<string>")).alias("names"))
        rest = last.filter("NOT (_new AND event_type != 'deleted')").select("path", "ts", "event_type", F.when(~F.col("_new"), F.col("names")).alias("names"))
        return parsed.union(rest)

    return table.follow(events, checkpoint, prepare, combine)


def live_rates(log: DataFrame, table: KeyedTable, checkpoint: str, size: str = "1 minute", late: str = "10 minutes") -> StreamingQuery:
    """The counts of each window so far (begin, n, failed), updated as results come."""
    return table.follow(rates(log, size=size, late=late), checkpoint, mode="update")


def live_states(results: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """The last state of each repository (url, state, ts), so that a restart knows what is pending."""
    last = lambda rows: rows.groupBy("url").agg(F.max(F.struct("ts", "state")).alias("b")).select("url", "b.state", "b.ts")
    return table.follow(results, checkpoint, last, lambda current, new: last(current.union(new)))
