"""What small tables do not show: long numbers, and joins whose sides grow with the corpus."""

import re

import pytest
from pyspark.sql import functions as F

from plexus import catalog, catalog_code, catalog_sources  # noqa: F401


@pytest.mark.parametrize("name", ["R06", "R06_stream"])
def test_errors_of_long_numbers(spark, tmp_path, name):
    ids = [5, 999999, 1234567, 12345678, 123456789012]
    kind = F.when(F.col("event_id") == 5, "click").otherwise("error")
    rows = spark.createDataFrame([(i,) for i in ids], "event_id bigint").withColumns({"ts": F.lit("2024-01-01").cast("timestamp_ntz"), "user_id": F.lit(1).cast("bigint"), "event_type": kind, "value": F.lit(1.0), "props": F.lit('{"k": 1}')})
    rows.write.parquet(f"{tmp_path}/events.parquet")
    assert [tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()] == [("bad {num}", 4)]


@pytest.mark.parametrize("name", ["E10", "E12_typed", "E14"])
def test_inference_broadcasts_nothing(spark, tmp_path, name):
    """Sources look as small as the table of numbers that they are made from, so a broadcast of them fails at size."""
    catalog_code._TYPED.clear()
    spark.range(40).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    seen = spark._jsparkSession.sharedState().statusStore()
    before = seen.executionsCount()
    assert catalog.QUERIES[name](spark, str(tmp_path)).count() == 40 * {"E10": 3, "E14": 5, "E12_typed": 7}[name]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    runs = seen.executionsList(before, 10_000)
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    assert len(plans) > 10
    # The project's top folders are a small table; nothing else goes to the driver.
    assert sum(len(set(re.findall(r"BroadcastExchange \((\d+)\)", p))) > 0 for p in plans) <= 1


@pytest.mark.parametrize("name", ["E12_typed", "E14"])
def test_inference_parses_once_and_reads_columns(spark, tmp_path, name):
    """One task parses a source for all rows of it, and no round reads whole rows of earlier ones again."""
    catalog_code._TYPED.clear()
    spark.range(10).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    seen = spark._jsparkSession.sharedState().statusStore()
    before = seen.executionsCount()
    assert catalog.QUERIES[name](spark, str(tmp_path)).count() == 10 * {"E14": 5, "E12_typed": 7}[name]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    runs = seen.executionsList(before, 10_000)
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    assert sum("MapInArrow" in p or "MapInPandas" in p for p in plans) == 1
    # Rows of the project's roots are made by the session; all others are read from columns.
    assert sum("Scan ExistingRDD" in p for p in plans) <= 1


def test_inference_sends_the_driver_nothing_that_grows(spark, tmp_path):
    """E14 alone: a task's answer to the driver is as long as its metrics, however many rows it has."""
    catalog_code._TYPED.clear()
    spark.range(400).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        every = store.stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return {x.stageId(): (x.resultSize(), x.numCompleteTasks()) for x in (every.apply(i) for i in range(every.size()))}

    before = stages()
    catalog.QUERIES["E14"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    own = [size / n for k, (size, n) in stages().items() if k not in before and n]
    assert len(own) > 10
    assert max(own) < 40_000
    assert spark.read.parquet(f"{tmp_path}/out").count() == 400 * 5
