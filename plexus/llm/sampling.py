"""Bounded samples of labelled rows for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
MAX_LABELS = 1000
#: Bytes of the texts of one label at most.
MAX_BYTES = 32 << 20


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod FOLDS; null ids are in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0)).cast("int")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def training_rows(docs: DataFrame, per_label: int, labels: DataFrame | None = None, max_bytes: int = MAX_BYTES) -> list[tuple[str, object]]:
    """Whole texts of at most ``per_label`` rows and ``max_bytes`` bytes for each label, in a fixed order.

    ``docs`` has doc_id, text and, unless ``labels`` (one row a doc_id) has it, label. Only rows outside fold 0 are used,
    and equal rows once. Rows are drawn by a hash of id and text: their kinds are counted first (approximately), a range
    of the hash that holds about 1.2 * per_label is drawn for each label, and its rows are taken in the hash's order as
    long as they fit in ``max_bytes``; if none fits, the shortest. Only hashes and lengths of the drawn rows, at most twice
    as many as expected, and the texts that are taken come to the driver. More than MAX_LABELS labels are an error.
    """
    key = ["doc_id", "text"] if labels is not None else ["doc_id", "text", "label"]
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("text").isNotNull()).withColumn("_o", F.xxhash64(*key))
    brief = usable.select("doc_id", "_o", F.octet_length("text").alias("_n"), *(["label"] if labels is None else []))
    marked = (brief if labels is None else brief.join(labels, "doc_id")).filter("label is not null")
    found = marked.groupBy("label").agg(F.approx_count_distinct("_o", 0.02).alias("n")).orderBy("label").limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"there are more than {MAX_LABELS} labels")
    if not found:
        return []
    wanted = 1.2 * per_label + 20
    share = F.create_map(*[F.lit(x) for r in found for x in (r["label"], min(1.0, wanted / max(1, r["n"])))])
    inside = F.pmod(F.xxhash64("_o", F.lit("draw")), F.lit(1 << 40)) / F.lit(float(1 << 40)) < F.element_at(share, F.col("label"))
    drawn = marked.filter(inside).select("label", "_o", "_n").distinct()
    rows = drawn.orderBy("_o").limit(int(2 * wanted * len(found))).collect()
    taken = {}
    for label in dict.fromkeys(r["label"] for r in found):
        own, left = [(r["_o"], r["_n"]) for r in rows if r["label"] == label], max_bytes
        fits = []
        for o, n in own:
            if len(fits) < per_label and n <= left:
                fits.append(o)
                left -= n
        taken |= dict.fromkeys(fits or [o for o, _ in sorted(own, key=lambda x: x[::-1])[:1]], label)
    chosen = docs.sparkSession.createDataFrame([(o,) for o in taken], "_o bigint")  # at most per_label * MAX_LABELS rows
    texts = usable.join(F.broadcast(chosen), "_o", "left_semi").select("_o", "text").dropDuplicates(["_o"]).collect()
    return [(r["text"], taken[r["_o"]]) for r in sorted(texts, key=lambda r: (r["_o"], r["text"]))]
