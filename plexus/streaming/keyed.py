"""A table with one row a key that streams merge their micro-batches into, each with an effect of exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyedTable:
    """Rows by key in a shared folder, dealt to ``buckets`` by a hash of the key.

    A merge rewrites only the buckets of its keys, into a folder of its version, and then commits a list that says which
    version each bucket has. A merge that ends before its commit leaves nothing behind that is read, and its repetition
    writes the same folder again; a version that is committed is not merged a second time. So a stream that numbers its
    micro-batches can be stopped anywhere and started again. Merges come one after the other; readers see the last commit.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple[str, ...], buckets: int = 16):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, keys, buckets
        self.fields = spark.createDataFrame([], schema).schema.fields
        self.columns = [f.name for f in self.fields]

    def _at(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def versions(self) -> list[int]:
        """The committed versions in order."""
        files, at = self._at(f"{self.path}/commits")
        if not files.exists(at):
            return []
        found = [int(s.getPath().getName()) for s in files.listStatus(at) if files.exists(self._at(f"{s.getPath().toString()}/_SUCCESS")[1])]
        return sorted(found)

    def _held(self) -> dict[int, int]:
        """The version of each bucket that has rows, by the last commit."""
        done = self.versions()
        if not done:
            return {}
        rows = self.spark.read.schema("bucket int, version bigint").json(f"{self.path}/commits/{done[-1]}").collect()  # one row a bucket
        return {r["bucket"]: r["version"] for r in rows}

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, held: dict[int, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{v}/bucket={b}" for b, v in sorted(held.items())])

    def read(self) -> DataFrame:
        return self._read(self._held())

    def merge(self, rows: DataFrame, version: int, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> None:
        """Merges ``rows`` as ``version``. ``combine`` gets the rows that the touched buckets have and the new ones; by default a new row replaces that of its key.

        New rows have one row a key unless ``combine`` sees to it.
        """
        if version in self.versions():
            return
        touched = [r["b"] for r in rows.select(self._bucket().alias("b")).distinct().collect()]  # at most one row a bucket
        held = self._held()
        current = self._read({b: v for b, v in held.items() if b in touched})
        new = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.fields])
        out = combine(current, new) if combine else current.join(new.select(*self.keys), list(self.keys), "left_anti").select(*self.columns).union(new)
        at = f"{self.path}/rows/{version}"
        out.select(*self.columns).withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
        files, folder = self._at(at)
        full = {int(s.getPath().getName().partition("=")[2]) for s in files.listStatus(folder) if s.getPath().getName().startswith("bucket=")}
        now = {b: v for b, v in held.items() if b not in touched} | dict.fromkeys(full, version)
        self.spark.createDataFrame(sorted(now.items()), "bucket int, version bigint").coalesce(1).write.mode("overwrite").json(f"{self.path}/commits/{version}")

    def vacuum(self) -> None:
        """Deletes what the last commit does not read, but for the commits."""
        used = set(self._held().values())
        files, at = self._at(f"{self.path}/rows")
        for s in files.listStatus(at) if files.exists(at) else []:
            if int(s.getPath().getName()) not in used:
                files.delete(s.getPath(), True)

    def follow(self, stream: DataFrame, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None, mode: str = "append"):
        """Merges a stream's micro-batches as they come, until what has arrived is used up; the checkpoint makes a restart go on."""
        put = lambda batch, n: self.merge(prepare(batch) if prepare else batch, n, combine)
        return stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
