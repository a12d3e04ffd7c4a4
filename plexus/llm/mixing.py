"""Mixing sources to target weights (operator 10), DataFrame operations only.

Every row gets a pseudo-random key from its doc_id. Rows are range-sorted by that key within their source: the key's
top bits name one of ``2**SLICE_BITS`` slices, slice totals are summed first, and a running sum inside each slice
completes a distributed prefix sum, so even a source that holds most rows is spread over all slices. Each source is
cut where the prefix sum reaches its budget; whole epochs are repeated before the cut.

Defined results: null text has size 0; null source is a source of its own, last in order; a source without words has
target 0; null doc_ids are keyed by their text, so they spread; very long texts count by all their words and may be cut; rows
of one key are ordered by doc_id, size and a digest of the whole row, so reruns cut the same text; an empty table gives no rows; further
columns pass through, whatever their names, but for the four that ``mix`` adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import WORD, n_words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
SLICE_BITS = 12
_KEY_BITS = 60


def targets(sizes: DataFrame) -> DataFrame:
    """From (_skey, source_size) to (_skey, source_size, target): water filling.

    Ordered by how soon a source reaches its ceiling, a source is capped exactly if its ceiling is below the level
    that the sources from it onwards would share. One row per source goes through the ordered window.
    """
    order = Window.orderBy("_skey")
    weighted = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int")).cast("long"))
    ceiling = F.col("source_size") * MAX_EPOCHS
    weighted = weighted.withColumn("_ceil", ceiling).withColumn("_ratio", F.col("_ceil") / F.col("_w"))
    fill = Window.orderBy("_ratio", "_skey")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("_ceil").over(before), F.lit(0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    )
    filled = weighted.withColumn("_level", level)
    shared = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_skey", "_level"))).over(everything)["_level"]
    target = F.when(F.col("_ratio") < F.col("_level"), F.col("_ceil").cast("double")).otherwise(F.least(F.col("_ceil").cast("double"), F.col("_w") * shared))
    return filled.select("_skey", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: str = SEED, slice_bits: int = SLICE_BITS) -> DataFrame:
    """``docs`` (doc_id, text, source and any others) plus size, source_size, target, taken.

    taken counts the words that the mix takes from the row, repeats included; a source's taken words sum to its target
    rounded to a whole number. A column of the input with one of the four names is replaced.
    """
    keep = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "taken")]
    key = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null/"), F.md5(F.coalesce("text", F.lit(""))))), F.lit(f"/{seed}"))), 1, _KEY_BITS // 4), 16, 10).cast("long")
    keyed = docs.select(
        F.struct(*keep).alias("_row"),
        F.col("doc_id").alias("_id"),
        F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("2")).alias("_skey"),
        key.alias("_key"),
        n_words(F.col("text")).alias("size"),
        F.xxhash64(*[c for c, kind in docs.dtypes if c in keep and "map<" not in kind]).alias("_digest"),
    ).withColumn("_slice", F.shiftright("_key", _KEY_BITS - slice_bits).cast("int"))
    slices = keyed.groupBy("_skey", "_slice").agg(F.sum("size").alias("_total"))
    prior = Window.partitionBy("_skey").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_offset", F.coalesce(F.sum("_total").over(prior), F.lit(0)))
    sources = targets(slices.groupBy("_skey").agg(F.sum("_total").alias("source_size")))
    plan = offsets.join(sources, "_skey").drop("_total")
    within = Window.partitionBy("_skey", "_slice").orderBy("_key", "_id", "size", "_digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(plan, ["_skey", "_slice"]).withColumn("_before", F.col("_offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - F.col("source_size") * epochs
    taken = F.col("size") * epochs + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    return placed.select("_row.*", "size", "source_size", "target", taken.cast("long").alias("taken"))


def materialise(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row per started epoch of each document; the one at a source's cut ends after its last taken word."""
    mixed = mix(docs.withColumn("_keep", F.struct(*docs.columns)), **options)
    full = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    left = (F.col("taken") - full * F.col("size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(None).cast("int"), full), F.when(left > 0, F.array(left)).otherwise(F.array().cast("array<int>")))
    rows = mixed.select("_keep", F.explode(copies).alias("_cut"))
    pieces = F.regexp_extract_all(F.col("_keep.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("_cut")), "")
    text = F.when(F.col("_cut").isNull(), F.col("_keep.text")).otherwise(cut)
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"_keep.{c}").alias(c) for c in docs.columns])


def sql(seed: str = SEED) -> str:
    """The same in SQL for DuckDB: doc_id, size, source_size, target, taken."""
    w = ", ".join(map(str, WEIGHTS))
    return f"""WITH d AS (SELECT doc_id, coalesce('1' || source, '2') AS s, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
('0x' || left(md5(coalesce(doc_id::VARCHAR, 'null/' || md5(coalesce(text, ''))) || '/{seed}'), {_KEY_BITS // 4}))::BIGINT AS k FROM documents),
z AS (SELECT s, sum(size)::BIGINT AS source_size FROM d GROUP BY s),
w AS (SELECT *, ([{w}])[(row_number() OVER (ORDER BY s) - 1) % {len(WEIGHTS)} + 1]::BIGINT AS w, source_size * {MAX_EPOCHS} AS c FROM z),
f AS (SELECT *, c / w AS ratio, (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(c) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM w WINDOW b AS (ORDER BY c / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT s, source_size, CASE WHEN ratio < level THEN c::DOUBLE ELSE least(c::DOUBLE, w * (SELECT arg_min(level, (ratio, s)) FROM f WHERE ratio >= level)) END AS target FROM f),
p AS (SELECT d.*, source_size, target, round(target)::BIGINT AS budget, coalesce(sum(size) OVER (PARTITION BY s ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN t USING (s)),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * epochs + greatest(0, least(size, budget - source_size * epochs - before)))::BIGINT AS taken FROM e"""
