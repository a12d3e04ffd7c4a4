"""Keyed tables that streams merge into: stops, repetitions and events out of order."""

from collections import Counter

import pytest
from plexus.streaming import jobs
from plexus.streaming.keyed import KeyedTable
from pyspark.sql import functions as F


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, f"file://{tmp_path}/t", "k string, v int", ("k",), buckets=3)


def rows(spark, **values):
    return spark.createDataFrame(list(values.items()), "k string, v int")


def held(t):
    return {r["k"]: r["v"] for r in t.read().collect()}


def test_rows_are_replaced_by_key_and_versions_count_once(spark, table):
    assert held(table) == {} and table.versions() == []
    table.merge(rows(spark, a=1, b=2, c=3, d=4), 0)
    table.merge(rows(spark, b=5), 1)
    table.merge(rows(spark, b=99, e=1), 1)  # the same batch once more
    assert held(table) == {"a": 1, "b": 5, "c": 3, "d": 4} and table.versions() == [0, 1]
    table.merge(spark.createDataFrame([], "k string, v int"), 2)
    table.merge(rows(spark, a=0), 3, lambda current, new: current.filter("v != 1"))  # only removes
    table.vacuum()
    assert held(table) == {"b": 5, "c": 3, "d": 4}


def test_a_merge_that_ends_before_its_commit_has_no_effect(spark, table, monkeypatch):
    table.merge(rows(spark, a=1, b=2), 0)
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_at", lambda self, path: (_ for _ in ()).throw(RuntimeError("stop")) if path.endswith("rows/1") else ORIGINAL(self, path))
        with pytest.raises(RuntimeError):
            table.merge(rows(spark, a=7, c=3), 1)
    assert held(table) == {"a": 1, "b": 2} and table.versions() == [0]
    table.merge(rows(spark, a=7, c=3), 1)
    assert held(table) == {"a": 7, "b": 2, "c": 3}


ORIGINAL = KeyedTable._at


def test_a_stream_that_stops_between_batches_goes_on(spark, tmp_path):
    """The batch that fails is merged when the stream starts again, and none twice: sums would show it."""
    t = KeyedTable(spark, f"file://{tmp_path}/t", "k string, v int", ("k",), buckets=2)
    add = lambda current, new: current.union(new).groupBy("k").agg(F.sum("v").cast("int").alias("v"))
    for i in range(6):
        rows(spark, a=1, **{f"x{i}": i}).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    seen = Counter()

    def failing(current, new):
        seen["n"] += 1
        if seen["n"] == 3:
            raise RuntimeError("stop")
        return add(current, new)

    with pytest.raises(Exception, match="stop"):
        t.follow(stream(), f"{tmp_path}/cp", combine=failing).awaitTermination()
    assert held(t)["a"] == 2
    t.follow(stream(), f"{tmp_path}/cp", combine=add).awaitTermination()
    assert held(t) == {"a": 6, **{f"x{i}": i for i in range(6)}}


def test_the_last_event_of_a_file_counts_in_any_order(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", jobs.LIVE, ("path",), buckets=2)
    parsed = Counter()

    def parse(paths):
        got = [r["path"] for r in paths.collect()]
        parsed.update(got)
        return spark.createDataFrame([(p, [f"n.{p}"]) for p in got], "path string, names array<string>")

    batches = [
        [("a.py", "created", False, 1), ("b.py", "created", False, 2), ("d", "created", True, 3)],
        [("a.py", "deleted", False, 9), ("c.py", "modified", False, 4), ("x/__pycache__/e.py", "created", False, 4)],
        [("a.py", "modified", False, 5), ("b.py", "modified", False, 6)],  # a.py: older than its deletion
    ]
    schema = "path string, event_type string, is_directory boolean, ts struct<at:timestamp,id:bigint>"
    for n, own in enumerate(batches):
        df = spark.createDataFrame([(p, e, d, i) for p, e, d, i in own], "path string, event_type string, is_directory boolean, i long")
        df = df.select("path", "event_type", "is_directory", F.struct(F.timestamp_seconds("i").alias("at"), F.col("i").alias("id")).alias("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        jobs.live_modules(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), t, f"{tmp_path}/cp", parse).awaitTermination()
    got = {r["path"]: (r["event_type"], r["names"]) for r in t.read().collect()}
    assert got == {"a.py": ("deleted", None), "b.py": ("modified", ["n.b.py"]), "c.py": ("modified", ["n.c.py"])}
    assert parsed["a.py"] == 1 and parsed["c.py"] == 1
