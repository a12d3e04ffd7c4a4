"""Quality rules (operator 6).

One pass measures every text and evaluates every rule, once. The ledger, a written table, keeps the measurements and a
bitmask of failed rules per document. Policies are versioned sets of rules: applying one is a bitwise test on the mask, and the ablation
of a policy (what each rule alone would remove, what would return if it were dropped) is an aggregation over masks.

Defined results: null and empty texts have no words and fail ``few_words``; texts of white space only likewise; very
long texts are measured whole; repeated rows are measured alike, each with a row of its own; a measurement equal to a
rule's limit passes; an empty table gives an empty ledger; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import n_words, scratch
from plexus.llm.textnum import batches, numbered_words, window_ids, windows

WINDOW = 5
#: Symbols counted by n_symbols, fixed.
SYMBOLS = "#*$%&|<>"

#: Name and failure condition of each rule; a rule's place is its bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("long_words", "word_chars > 14 * n_words"),
    ("short_words", "10 * word_chars < 22 * n_words"),
    ("shouting", "100 * n_marks > 40 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
#: Version to the rules that it applies.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "long_words", "short_words"),
    "v2": tuple(BIT),
}
CURRENT = "v2"
MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks")


def policy_mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def _alike(win: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows, and whether each but the first is like the one before it in that order."""
    order = np.lexsort((win, text))
    return order, (win[order][1:] == win[order][:-1]) & (text[order][1:] == text[order][:-1])


def _repeats(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: words in windows that are found twice or more in it."""
    for batch in batch_iter:
        texts = batch.column("text").to_pylist()
        out = np.zeros(len(texts), np.int64)
        for at, own in batches(texts):
            h, bounds = numbered_words(own)
            win, text, first = windows(h.astype(np.uint64), bounds, WINDOW, whole=False)
            if not len(win):
                continue
            order, same = _alike(win, text)
            here, before = first[order[1:][same]], first[order[:-1][same]]
            if any((h[here + k] != h[before + k]).any() for k in range(WINDOW)):  # unlike windows of one hash
                order, same = _alike(window_ids(h, WINDOW)[first], text)
            again = np.zeros(len(win), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            delta = np.zeros(len(h) + 1, np.int64)
            np.add.at(delta, first[again], 1)
            np.add.at(delta, first[again] + WINDOW, -1)
            covered = np.concatenate(([0], np.cumsum(np.cumsum(delta[:-1]) > 0)))
            out[at : at + len(own)] = covered[bounds[1:]] - covered[bounds[:-1]]
        rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
        names = [x for x in batch.schema.names if x != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(out)], [*names, "n_repeat_words"])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every row. Only the repeated windows need Python."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        "doc_id",
        n_words(text).alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_marks"),
        text.alias("text"),
    )
    schema = ", ".join(f"{c} {t}" for c, t in base.dtypes if c != "text") + ", n_repeat_words bigint"
    return base.mapInArrow(_repeats, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``failed``, the bitmask of failed rules."""
    mask = F.lit(0)
    for name, fails in RULES:
        mask = mask.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(0))
    return measure(docs).withColumn("failed", mask)


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    return rows.withColumn("kept", F.col("failed").bitwiseAND(policy_mask(policy)) == 0)


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: how many documents fail it, fail only it, and would be kept without it."""
    mask = policy_mask(policy)
    failed = F.col("failed").bitwiseAND(mask)
    # Masks are few, however many documents there are.
    masks = rows.groupBy(failed.alias("m")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in POLICIES[policy]])).alias("r")
    m, bit = F.col("m"), F.col("r.bit")
    return (
        masks.select("m", "n", each)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(m.bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(m == bit, F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(m.bitwiseAND(F.bitwise_not(bit)) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def written(docs: DataFrame, path: str) -> DataFrame:
    """The ledger, written to ``path`` and read again: policies and ablations never measure a text anew."""
    ledger(docs).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def judged(docs: DataFrame, policy: str = CURRENT, path: str | None = None) -> DataFrame:
    """The ledger, written to ``path`` or a folder of its own, with base_failed, the verdict ``kept`` of a policy, and that of every policy as kept_<version>."""
    rows = written(docs, path or scratch(docs.sparkSession, "ledger"))
    out = apply_policy(rows, policy).withColumn("base_failed", F.col("failed").bitwiseAND(policy_mask("base")) != 0)
    every = [(F.col("failed").bitwiseAND(policy_mask(p)) == 0).alias(f"kept_{p}") for p in POLICIES]
    return out.select("doc_id", *MEASURED, "base_failed", "kept", "failed", *every)


def sql(policy: str = CURRENT) -> str:
    """``judged`` in SQL for DuckDB."""
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    failed = " + ".join(f"CASE WHEN {fails} THEN {BIT[name]} ELSE 0 END" for name, fails in RULES)
    kept = lambda p: f"(failed & {policy_mask(p)}) = 0"
    every = ", ".join(f"{kept(p)} AS kept_{p}" for p in POLICIES)
    window = " || ' ' || ".join(["x", *(f"lead(x, {k}) OVER o" for k in range(1, WINDOW))])
    return f"""WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, regexp_extract_all(t, '{word}+') AS w FROM t),
u AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM w),
g AS (SELECT r, p, {window} AS g FROM u WINDOW o AS (PARTITION BY r ORDER BY p)),
x AS (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE g IS NOT NULL),
c AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + {WINDOW})) AS q FROM x WHERE n > 1) GROUP BY r),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '{word}')) AS l FROM t),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{space}', '', 'g'))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
(len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, (length(t) - length(replace(t, '!', '')))::BIGINT AS n_marks FROM t JOIN w USING (r) JOIN l USING (r) LEFT JOIN c USING (r)),
f AS (SELECT *, ({failed})::INT AS failed FROM m)
SELECT doc_id, {", ".join(MEASURED)}, NOT {kept("base")} AS base_failed, {kept(policy)} AS kept, failed, {every} FROM f"""
