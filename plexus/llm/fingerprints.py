"""Document fingerprints (operator 3), DataFrame operations only.

A threshold-scaled sketch keeps every shingle hash below a fixed fraction of the hash range. Two sketches of the same
fraction merge by union, and since both keep the same part of the hash range, containment and likeness of very unequal
documents follow from set sizes. A shingle is five lower-cased words; a text of fewer words is one shingle.

A text with words but no hash below the threshold keeps its least hash, so only texts without words have an empty
sketch. Likeness is intersection over union; two empty sketches are alike (1), an empty and a full one are not (0).

Neighbours: rows are dealt by ranges of doc_id, whose bounds are quantiles, and each range also gets a copy of the row
that follows it, so that a window inside the range sees every row's next one and no range meets all rows.

Defined results: null text counts as empty; null doc_ids come last; equal doc_ids are ordered by text; with one row,
the next document is the row itself; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import lower_ascii, shuffle_partitions, words

SHINGLE = 5
#: One of so many hashes is kept.
SCALE = 4
HEX = 12
RANGES_PER_PARTITION = 4
MAX_RANGES = 16384


def sketch(text: Column, scale: int = SCALE, k: int = SHINGLE) -> Column:
    """The kept hashes of a text, ascending, each below 2**48 / scale except for a lone least one."""
    tokens = F.transform(words(lower_ascii(text)), lambda w: F.xxhash64(w))
    limit = 2 ** (4 * HEX) // scale

    def hashed(w: Column) -> Column:
        n = F.size(w)
        one = lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), 64 - 4 * HEX)
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), one))

    def kept(h: Column) -> Column:
        low = F.filter(h, lambda x: x < limit)
        return F.when((F.size(low) == 0) & (F.size(h) > 0), F.array(F.array_min(h))).otherwise(F.array_sort(F.array_distinct(low)))

    # Each step is bound as a lambda argument, so it is computed once.
    step = F.transform(F.array(tokens), hashed)
    return F.get(F.transform(step, kept), 0)


def merged(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("double")
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def containment(a: Column, b: Column) -> Column:
    """How much of ``a`` is in ``b``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(h: Column) -> Column:
    return F.array_join(F.transform(h, lambda x: F.lower(F.lpad(F.hex(x), HEX, "0"))), "")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most ``key``, by two short scans."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    longs = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    table = F.transform(F.split(F.lit(";".join(",".join(map(str, b)) for b in blocks)), ";"), lambda s: F.split(s, ",").cast("array<bigint>"))
    coarse = F.size(F.filter(longs([b[0] for b in blocks]), lambda x: x <= key))
    fine = F.size(F.filter(F.get(table, coarse - 1), lambda x: x <= key))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<c>`` for each of ``columns``: its value in the following row by descending doc_id, cyclic."""
    n = min(MAX_RANGES, RANGES_PER_PARTITION * shuffle_partitions(docs.sparkSession))
    # Null ids come after all others in descending order.
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    quantiles = docs.select(F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n).alias("q")).first()["q"] or []
    bounds = sorted(set(quantiles))
    keyed = docs.withColumn("_k", key).withColumn("_range", _range_of(F.col("_k"), bounds))
    tops = {r["_range"]: r["top"] for r in keyed.groupBy("_range").agg(F.max("_k").alias("top")).collect()}  # at most n rows
    # The row after a range's last one is the largest of the next lower range that has rows; after the lowest comes the highest.
    filled = sorted(tops)
    above = {tops[r]: filled[(i + 1) % len(filled)] for i, r in enumerate(filled)}
    halo_of = F.create_map(*[F.lit(x) for k, v in above.items() for x in (k, v)]) if above else F.create_map().cast("map<bigint,int>")
    own = keyed.withColumn("_halo", F.lit(0))
    # The copy is the first row of its range by the same order as below.
    tied = Window.partitionBy("_k").orderBy(F.col("text").desc_nulls_last())
    first = keyed.filter(F.col("_k").isin(list(above)) if above else F.lit(False)).withColumn("_r", F.row_number().over(tied)).filter("_r = 1").drop("_r")
    halo = first.withColumn("_range", F.element_at(halo_of, F.col("_k")).cast("int")).withColumn("_halo", F.lit(1))
    order = Window.partitionBy("_range").orderBy(F.col("_halo"), F.col("_k").desc(), F.col("text").desc_nulls_last())
    rows = own.unionByName(halo)
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    return rows.filter("_halo = 0").drop("_k", "_range", "_halo")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(text.substr(F.lit(1), F.length(text) - half), following.substr(F.lit(1), half))


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """doc_id, text, sketch (array of long) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), sketch(text, scale).alias("sketch"))


def against_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    rows = with_next(fingerprints(docs), ["text", "sketch"])
    new = rows.withColumn("_edited", edited(F.col("text"), F.col("next_text")))
    new = new.withColumn("_edited_sketch", sketch(F.col("_edited")))
    return new.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("_edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
