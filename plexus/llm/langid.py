"""Language identification (operator 8).

Hashed subwords (byte n-grams inside a text) have embeddings; a text's embeddings are averaged and a linear softmax
gives the language. Embeddings and softmax are trained by stochastic gradient descent in numpy on the whole texts of a
bounded sample (``PER_LABEL`` rows of each language; more than ``MAX_LABELS`` languages are an error). A temperature and
a rejection threshold are calibrated on a part of the sample that training does not see.

For prediction each subword's embedding is multiplied with the softmax matrix once, so a text's logits are a mean of
table rows, taken over the whole text.

Defined results: ``und`` with score 0 for null texts and texts without a letter; ``rejected`` marks further texts whose
calibrated probability is below the threshold (the language stays the likeliest); repeated rows are alike; ties go to
the first language by code point; without any labelled row every text is ``und``; very long texts are judged by all their
subwords; an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.sampling import held_out, training_rows
from plexus.llm.textnum import batches

SLOTS = 1 << 15
DIM = 16
ORDERS = (2, 3, 4)
PER_LABEL = 600
EPOCHS = 6
RATE = 20.0
#: Share of the calibration texts that may be rejected though they are right.
REJECT_RIGHT = 0.001


def lowered(b: bytes) -> np.ndarray:
    return np.frombuffer(b.lower(), np.uint8).astype(np.uint32)


def subwords(data: np.ndarray) -> list[np.ndarray]:
    """The slot of the n-gram that begins at each byte, for each order."""
    out, acc = [], np.zeros(len(data), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        m = len(data) - n + 1
        if m <= 0:
            break
        acc = acc[:m] * np.uint32(0x01000193) + data[n - 1 :] + np.uint32(1)
        if n in ORDERS:
            mixed = acc * np.uint32(0x9E3779B1) + np.uint32(n)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)
            out.append(mixed >> np.uint32(32 - SLOTS.bit_length() + 1))
    return out


def text_slots(text: str) -> np.ndarray:
    found = subwords(lowered(b" " + text.encode("utf-8", "replace") + b" "))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 7) -> dict:
    """``rows``: (text, language). Returns the table of logits by slot, the languages, temperature and threshold."""
    labels = sorted({y for _, y in rows})
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (SLOTS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(labels)), np.float32), np.zeros(len(labels), np.float32)
    data = [(np.unique(s, return_counts=True), labels.index(y)) for t, y in rows if (s := text_slots(t)).size]
    n_cal = len(data) // 6
    cal, fit = data[:n_cal], data[n_cal:]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(fit)):
            (slots, counts), y = fit[i]
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ emb[slots]
            g = softmax(mean @ out + bias)
            g[y] -= 1
            back = out @ g
            out -= np.float32(rate * 0.02) * np.outer(mean, g)
            bias -= np.float32(0.001) * g
            emb[slots] -= np.float32(rate) * share[:, None] * back
    table = emb @ out
    z = np.array([(c / c.sum()) @ table[s] + bias for (s, c), _ in cal]).reshape(-1, len(labels))
    y = np.array([y for _, y in cal], int)
    grid = np.geomspace(0.05, 20, 40)
    loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() if len(y) else 0 for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(z / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y]) if len(y) else np.zeros(0)
    threshold = float(min(0.5, right[int(REJECT_RIGHT * len(right))])) if len(right) else 0.0
    return {"table": table.astype(np.float32), "bias": bias, "labels": labels, "temperature": temperature, "threshold": threshold}


def logits(model: dict, own: list[bytes]) -> np.ndarray:
    """Mean table row over all subwords of each text."""
    data = lowered(b" " + b" ".join(own) + b" ")
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    begin = np.concatenate(([0], ends[:-1]))
    columns = [np.ascontiguousarray(c) for c in model["table"].T]
    out, count = np.zeros((len(own), len(columns))), np.zeros(len(own))
    for n, slots in zip(ORDERS, subwords(data), strict=False):
        stop = np.maximum(ends + 2 - n, begin)  # the spaces around a text belong to it
        cut = np.minimum(np.stack((begin, stop), axis=1).ravel(), len(slots))
        some, slots = (stop > begin)[:, None], slots.astype(np.intp)
        sums = np.stack([np.add.reduceat(np.append(np.take(column, slots), np.float32(0)), cut, dtype=np.float64)[::2] for column in columns], axis=1)
        out += np.where(some, sums, 0)
        count += stop - begin
    return out / np.maximum(count, 1)[:, None] + model["bias"]


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)  # SLOTS rows whatever the corpus

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in it:
            texts = batch.column("text").to_pylist()
            letter = np.array(batch.column("letter").to_pylist(), bool)
            lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if m:
                for at, own in batches(texts):
                    p = softmax(logits(m, own) / m["temperature"])
                    lang[at : at + len(own)] = np.array(m["labels"], object)[p.argmax(axis=1)]
                    score[at : at + len(own)] = p.max(axis=1)
                lang[~letter], score[~letter] = "und", 0.0
            low = score < (m["threshold"] if m else 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(low)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    id_type = dict(docs.dtypes)["doc_id"]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text.alias("text"), text.rlike(r"\p{L}").alias("letter"))
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, rejected boolean")


def learn(docs: DataFrame) -> dict | None:
    rows = training_rows(docs.select("doc_id", "text", F.col("lang").alias("label")), PER_LABEL)
    return train(rows) if rows else None
