"""Centroid clustering of whole-number vectors (operator 11): Lloyd's rounds whose assignments are exact.

A component x becomes the integer floor(SCALE * x). Each task multiplies its vectors with the centroids in float32. The
product's rounding error is at most ``(d + 2) u / (1 - (d + 2) u) |v| |c|`` (u = 2**-24), whatever the order of its
additions, so every distance has an interval that surely holds it. A centroid whose interval begins above the end of the
lowest one cannot win; where several are left, they are recomputed with integers, and of equal distances the lowest
number wins. Components beyond ``SMALL`` leave the matrix product: such vectors and centroids are computed with Python's
integers, which have no bound.

Only the centroids (k rows) are on the driver. A task sends back at most k * (d + 1) sums and counts a round, which Spark
adds up; vectors are not shuffled, and the table is read anew in each round, so nothing grows but the number of tasks.

Defined results: a vector that is null, of another length, or holds a null, NaN or infinity is left out; so is an empty
table, and with fewer vectors than k there are as many centroids as vectors. Null ids come last among the first
centroids; equal ids are ordered by their components; repeated rows are clustered each for itself. Distances and sums
beyond 64 bits are given as the largest long. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import checkpoint

DIMENSIONS, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"
#: Largest component for which squares of differences of DIMENSIONS components fit in 64 bits.
SMALL = 1 << 26
#: Bits of a digit of the sums of larger components.
DIGIT = 32
LARGEST = (1 << 63) - 1
_UNIT = 2.0**-24


def usable(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and embedding of the vectors that have ``dimensions`` finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select("vec_id", "embedding").filter((F.size("embedding") == dimensions) & F.coalesce(F.forall("embedding", finite), F.lit(False)))


def whole(x: float, scale: int = SCALE) -> int:
    """floor(scale * x); exact, also where the product is beyond a double. ``scale`` is a power of two."""
    return math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale


def first(kept: DataFrame, k: int = K, seed: str = SEED) -> list[list[int]]:
    """The vectors whose ids hash lowest, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "embedding").limit(k).collect()
    return [[whole(x) for x in r["embedding"]] for r in rows]


def distance(v: list[int], c: list[int]) -> int:
    return sum((a - b) * (a - b) for a, b in zip(v, c, strict=True))


class Nearest:
    """Assigns rows of integers to the nearest of fixed centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        near = [j for j, c in enumerate(centroids) if max(map(abs, c), default=0) <= SMALL]
        self.near = np.array(near, dtype=np.int64)
        self.exact = np.array([centroids[j] for j in near], dtype=np.int64).reshape(len(near), len(centroids[0]))
        #: Of the others: the number and the size of the largest component.
        self.far = [(j, max(map(abs, c))) for j, c in enumerate(centroids) if max(map(abs, c), default=0) > SMALL]
        wide = self.exact.astype(np.float64)
        self.matrix = np.ascontiguousarray(wide.T.astype(np.float32))
        self.squares = (wide * wide).sum(axis=1)
        self.norms = np.sqrt(self.squares) * (1 + 1e-12)

    def shortlist(self, v: np.ndarray) -> np.ndarray:
        """For each row of ``v`` (integers up to SMALL) which of the near centroids may be the nearest."""
        wide = v.astype(np.float64)
        product = (v.astype(np.float32) @ self.matrix).astype(np.float64)
        terms = (v.shape[1] + 2) * _UNIT
        norms = np.sqrt((wide * wide).sum(axis=1)) * (1 + 1e-12)
        # Twice the product's error, and that of the few double operations here.
        around = 2 * terms / (1 - terms) * norms[:, None] * self.norms[None, :] * (1 + 1e-12)
        score = self.squares[None, :] - 2 * product
        around += 2.0**-48 * (self.squares[None, :] + 2 * np.abs(product)) + 2.0**-40
        return score - around <= (score + around).min(axis=1)[:, None]

    def small(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and distance of rows of small integers."""
        if not len(self.near):
            return self.large(v.tolist())
        open_ = self.shortlist(v)
        best = open_.argmax(axis=1)
        unsure = np.flatnonzero(open_.sum(axis=1) > 1)
        if len(unsure):
            at, j = np.nonzero(open_[unsure])
            gap = v[unsure[at]] - self.exact[j]
            # Sorted by row, then distance, then number, so the first of each row is the answer.
            d = (gap * gap).sum(axis=1)
            order = np.lexsort((j, d, at))
            rows, firsts = np.unique(at[order], return_index=True)
            best[unsure[rows]] = j[order][firsts]
        gap = v - self.exact[best]
        d, out = (gap * gap).sum(axis=1), self.near[best]
        if self.far:
            # A far centroid is at least as far as its largest component is beyond the row's.
            reach = np.abs(v).max(axis=1)
            least = min(size for _, size in self.far)
            again = [i for i, (x, r) in enumerate(zip(d.tolist(), reach.tolist(), strict=True)) if (least - r) ** 2 <= x]
            if again:
                out[again], d[again] = self.large(v[again].tolist())
        return out, d

    def large(self, rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The same with Python's integers."""
        found = [min((distance(v, c), j) for j, c in enumerate(self.centroids)) for v in rows]
        return np.array([j for _, j in found], dtype=np.int64), np.array([min(d, LARGEST) for d, _ in found], dtype=np.int64)


def integers(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Which rows are small, their integers, and the integers of the others."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    is_small = (np.abs(x) < SMALL / SCALE).all(axis=1)
    return is_small, np.floor(x[is_small] * SCALE).astype(np.int64), [[whole(float(a)) for a in r] for r in x[~is_small]]


def _assigned(batches: Iterator[pa.RecordBatch], nearest: Nearest, dimensions: int) -> Iterator[tuple]:
    """Of each batch: the batch, cluster and distance of each row, and the integers as above."""
    for batch in batches:
        if not batch.num_rows:
            continue
        is_small, small, large = integers(batch.column("embedding"), dimensions)
        cluster, d = np.empty(len(is_small), np.int64), np.empty(len(is_small), np.int64)
        cluster[is_small], d[is_small] = nearest.small(small)
        if large:
            cluster[~is_small], d[~is_small] = nearest.large(large)
        yield batch, cluster, d, is_small, small, large


def _sums(centroids: list[list[int]], dimensions: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One task's (cluster, part, value): part -1 counts rows, part i + d * e sums the digits e of the components i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest, k = Nearest(centroids), len(centroids)
        total, count, digits = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64), {}
        for _, cluster, _, is_small, small, large in _assigned(batches, nearest, dimensions):
            np.add.at(total, cluster[is_small], small)
            count += np.bincount(cluster, minlength=k)
            for j, row in zip(cluster[~is_small].tolist(), large, strict=True):
                for i, x in enumerate(row):
                    e = 0
                    while not -(1 << DIGIT) < x < 1 << DIGIT:
                        digits[j, i + dimensions * e] = digits.get((j, i + dimensions * e), 0) + (x & ((1 << DIGIT) - 1))
                        x, e = x >> DIGIT, e + 1
                    digits[j, i + dimensions * e] = digits.get((j, i + dimensions * e), 0) + x
        own = np.flatnonzero(count).tolist()
        rows = [(j, -1, int(count[j])) for j in own] + [(j, i, int(total[j, i])) for j in own for i in range(dimensions)]
        rows += [(j, part, x) for (j, part), x in digits.items()]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())], ["cluster", "part", "value"])

    return run


def moved(kept: DataFrame, centroids: list[list[int]], dimensions: int = DIMENSIONS) -> list[list[int]]:
    """The centroids after one round: every non-empty one becomes its vectors' floor(sum / count)."""
    parts = kept.select("embedding").mapInArrow(_sums(centroids, dimensions), "cluster int, part int, value bigint")
    rows = parts.groupBy("cluster", "part").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect()
    count, total = {}, {}
    for r in rows:
        if r["part"] < 0:
            count[r["cluster"]] = int(r["value"])
        else:
            at = r["cluster"], r["part"] % dimensions
            total[at] = total.get(at, 0) + (int(r["value"]) << DIGIT * (r["part"] // dimensions))
    return [[total.get((j, i), 0) // count[j] for i in range(dimensions)] if j in count else c for j, c in enumerate(centroids)]


def assigned(kept: DataFrame, centroids: list[list[int]], dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        for batch, cluster, d, *_ in _assigned(batches, nearest, dimensions):
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def fitted(kept: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED, dimensions: int = DIMENSIONS) -> list[list[int]]:
    centroids = first(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(kept, centroids, dimensions)
    return centroids


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def _long(x: Column) -> Column:
    return F.least(x, F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint")


def clustered(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector."""
    kept = usable(vectors, dimensions)
    centroids = fitted(kept, k, rounds, seed, dimensions)
    rows = checkpoint(assigned(kept, centroids, dimensions)) if centroids else assigned(kept.limit(0), [[0] * dimensions], dimensions)
    # At most k rows from here on, so they are sent to all tasks.
    own = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s"))
    names = vectors.sparkSession.createDataFrame([(j, digest(c)) for j, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    facts = own.withColumn("t", F.sum("s").over(Window.partitionBy())).join(F.broadcast(names), "cluster").select("cluster", _long(F.col("s")).alias("cluster_inertia"), _long(F.col("t")).alias("inertia"), "centroid_sha256")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(k: int = K, rounds: int = ROUNDS, seed: str = SEED, dimensions: int = DIMENSIONS) -> str:
    """The same in SQL for DuckDB, round by round; for components whose squared distances fit in 64 bits."""
    finite = f"len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dimensions}"
    ctes = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS p FROM embeddings WHERE {finite})",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, embedding) - 1)::INT AS cluster, p FROM v QUALIFY cluster < {k})",
    ]
    gap = "list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        ctes.append(f"a{i} AS MATERIALIZED (SELECT r, min({{'d': {gap}, 'j': cluster}}) AS m FROM v, c{i} c GROUP BY r)")
        if i < rounds:
            ctes.append(f"s{i} AS (SELECT a{i}.m.j AS cluster, i, sum(v.p[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM v JOIN a{i} USING (r), range(1, {dimensions + 1}) t(i) GROUP BY ALL)")
            ctes.append(f"m{i} AS (SELECT cluster, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY i) AS p FROM s{i} GROUP BY cluster)")
            ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.p, c{i}.p) AS p FROM c{i} LEFT JOIN m{i} USING (cluster))")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT v.vec_id, cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN c{rounds} c ON c.cluster = m.j"""
