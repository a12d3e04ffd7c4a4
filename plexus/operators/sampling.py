"""Seeds, samples and packing of text into budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.plans.graph import PropertyGraph, durable


def hash_order(key: Column, salt: str) -> Column:
    """A fixed pseudo-random order that other engines can repeat."""
    return F.md5(F.concat(key.cast("string"), F.lit(salt)))


def seed_scores(g: PropertyGraph, min_connections: int = 3) -> DataFrame:
    """node_id, calls, all_rels, score of functions and methods with connections or length enough."""
    e = g.edges
    sides = e.select(F.col("src").alias("node_id"), "type").union(e.select("dst", "type"))
    rels = sides.groupBy("node_id").agg(F.count("*").alias("all_rels"), F.count_if(F.col("type") == "CALLS").alias("calls"))
    n = g.label("Function", "Method").join(rels, "node_id", "left").fillna(0, ["all_rels", "calls"])
    span = F.greatest(F.coalesce("end_line", F.lit(0)) - F.coalesce("start_line", F.lit(0)), F.lit(0))
    score = 10 * F.col("calls") + 2 * F.col("all_rels") + F.least(span, F.lit(50)) + F.when(F.length("docstring") > 0, 5).otherwise(0)
    return n.filter((F.col("all_rels") >= min_connections) | (span >= 10)).select("node_id", "calls", "all_rels", score.cast("bigint").alias("score"))


def sparse_seeds(g: PropertyGraph) -> DataFrame:
    """node_id, total and best relation of functions and methods, classes and modules."""
    c = F.count_if
    e = g.edges
    sides = e.select(F.col("src").alias("node_id"), "type", F.lit("out").alias("way")).union(e.select("dst", "type", F.lit("in")))
    is_ = lambda t, *w: (F.col("type") == t) & (F.col("way").isin(*w) if w else F.lit(True))
    n = sides.groupBy("node_id").agg(
        c(is_("CALLS")).alias("calls"), c(is_("DEFINES", "in") | is_("DEFINES_METHOD", "in")).alias("defined"), c(is_("INHERITS")).alias("inherits"), c(is_("DEFINES_METHOD", "out")).alias("methods"), c(is_("IMPORTS")).alias("imports"), c(is_("DEFINES", "out")).alias("defines")
    )
    all_ = g.label("Function", "Method", "Class", "Module").select("node_id", "label").join(n, "node_id")
    code = F.col("label").isin("Function", "Method")
    total = F.when(code, F.col("calls") + F.col("defined")).when(F.col("label") == "Class", F.col("inherits") + F.col("methods")).otherwise(F.col("imports") + F.col("defines"))
    best = F.when(code, F.when(F.col("calls") >= F.col("defined"), "CALLS").otherwise("DEFINES")).when(F.col("label") == "Class", "INHERITS").otherwise("IMPORTS")
    return all_.select("node_id", total.alias("total"), best.alias("best")).filter("total > 0")


def weighted_sample(rows: DataFrame, key: str, weight: str, k: int, salt: str) -> DataFrame:
    """K rows without repetition, likelier by weight: the largest log(u) / weight, u from a hash of the key."""
    u = (F.conv(F.substring(hash_order(F.col(key), salt), 1, 12), 16, 10).cast("double") + 1) / float(16**12 + 1)
    return rows.withColumn("_k", F.log(u) / F.col(weight)).orderBy(F.desc("_k"), key).limit(k).drop("_k")


def packed(chunks: DataFrame, budget: int) -> DataFrame:
    """Seed and picked ids in order. chunks: seed, node, depth, size; a chunk that doesn't fit is passed over.

    A seed's chunks are bounded by its expansion's cap; only ids and sizes are folded, never texts.
    """
    rows = chunks.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("depth", F.lit(999)).alias("d"), "node", "size"))).alias("c"))
    start = F.struct(F.lit(0).cast("bigint").alias("used"), F.array().cast("array<bigint>").alias("picked"))
    step = lambda a, x: F.when(a["used"] + x["size"] > budget, a).otherwise(F.struct((a["used"] + x["size"]).cast("bigint").alias("used"), F.array_append(a["picked"], x["node"]).alias("picked")))
    return rows.select("seed", F.aggregate("c", start, step).alias("a")).select("seed", F.array_join("a.picked", ",").alias("picked"), F.col("a.used").alias("used"))


def round_robin(seeds: DataFrame, weights: dict[str, int], most: int = 5) -> DataFrame:
    """Seed, strategy, turn: every strategy of a seed as often as its weight, at most ``most`` times."""
    table = F.explode(F.array(*[F.struct(F.lit(k).alias("strategy"), F.lit(v).alias("w")) for k, v in weights.items()])).alias("s")
    return seeds.select("seed", table).select("seed", "s.strategy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("s.w", F.lit(most)).cast("bigint"))).alias("turn"))


def numbered(rows: DataFrame, order: list[str], name: str, form: str = "prompt_%04d") -> DataFrame:
    """Rows with a running number by ``order``: sorted by ranges, numbered per range from the counts before it."""
    sorted_ = rows.orderBy(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    fixed = durable(sorted_)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = fixed.groupBy("_p").agg(F.count("*").alias("n"), F.min("_i").alias("_first")).withColumn("_o", F.coalesce(F.sum("n").over(before), F.lit(0)))  # a row per partition
    number = F.col("_i") - F.col("_first") + F.col("_o")
    return fixed.join(F.broadcast(offsets), "_p").withColumn(name, F.format_string(form, number) if form else number).drop("_p", "_i", "n", "_first", "_o")
