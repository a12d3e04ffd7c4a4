"""Quality classifier (operator 9): a byte-level convolutional network in numpy.

A text's bytes are embedded; filters of ``WIDTH`` bytes, ``STRIDE`` apart, run over overlapping chunks that cover the
whole text; each chunk's responses are max-pooled, and the chunk vectors' maximum and mean over the text feed one
logistic unit. Filters, embeddings and unit are trained by Adam on the whole texts of a bounded sample (``PER_LABEL`` rows
of each label).

Defined results: null and empty texts are scored as one empty chunk; the score of a text depends on nothing else in its
table; repeated rows are alike; very long texts are scored by all their chunks, some thousand at a time; a score equal to
the threshold is accepted; of unlike labels of one doc_id the least counts; without labelled rows every score is the prior
0.5; an empty table gives no rows; further columns are ignored or kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plexus.llm.sampling import held_out, training_rows

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE = 8, 4
EMBED, FILTERS = 8, 24
PER_LABEL = 1000
#: Bytes of the short excerpts.
SHORT = (20, 300)
EPOCHS = 7
BATCH = 32
RATE = 0.004
THRESHOLD = 0.3
PAD = 256
_PATCHES = (CHUNK - WIDTH) // STRIDE + 1


def chunks(b: bytes) -> np.ndarray:
    """Overlapping chunks over all bytes; the last one is padded."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(b) - OVERLAP) // step))
    out = np.full(n * step + OVERLAP, PAD, np.int16)
    out[: len(b)] = np.frombuffer(b, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(out, CHUNK)[::step]


def patches(rows: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(rows, WIDTH, axis=1)[:, ::STRIDE]


def pooled(model: dict, rows: np.ndarray) -> np.ndarray:
    """Max-pooled responses of each chunk; rectified after pooling, which comes to the same."""
    e = model["emb"][rows].reshape(len(rows), -1)
    view = np.lib.stride_tricks.as_strided(e, (len(rows), _PATCHES, WIDTH * EMBED), (e.strides[0], e.itemsize * EMBED * STRIDE, e.itemsize))
    z = np.ascontiguousarray(view).reshape(-1, WIDTH * EMBED) @ model["filters"]
    return np.maximum(z.reshape(len(rows), _PATCHES, FILTERS).max(axis=1) + model["fbias"], 0)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def combine(model: dict, vec: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of each text from its chunks' vectors; ``first``: where each text's chunks begin."""
    n = np.diff(np.append(first, len(vec)))[:, None]
    feats = np.concatenate((np.maximum.reduceat(vec, first), np.add.reduceat(vec, first) / n), axis=1)
    return sigmoid(feats @ model["unit"] + model["ubias"][0])


def train(rows: list[tuple[str, int]], seed: int = 11) -> dict:
    rng = np.random.default_rng(seed)
    p = {
        "emb": rng.normal(0, 0.5, (257, EMBED)), "filters": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)),
        "fbias": np.zeros(FILTERS), "unit": rng.normal(0, 0.1, 2 * FILTERS), "ubias": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["emb"][PAD] = 0
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    texts = [((t or "").encode("utf-8", "replace"), float(y)) for t, y in rows]
    # Short excerpts join the sample, so that short texts are judged by what they hold and not by their length.
    for b, y in list(texts):
        n = int(rng.integers(*SHORT))
        at = int(rng.integers(0, max(1, len(b) - n)))
        texts.append((b[at : at + n], y))
    data = [(chunks(b), y) for b, y in texts]
    weight = {y: len(data) / (2 * max(1, sum(v == y for _, v in data))) for y in (0.0, 1.0)}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for k in range(0, len(order), BATCH):
            some = [data[i] for i in order[k : k + BATCH]]
            step += 1
            for name, g in gradients(p, some, weight).items():
                m1[name] = 0.9 * m1[name] + 0.1 * g
                m2[name] = 0.99 * m2[name] + 0.01 * g * g
                p[name] -= (RATE * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return p


def gradients(p: dict, some: list, weight: dict) -> dict:
    rows = np.concatenate([c for c, _ in some])
    sizes = np.array([len(c) for c, _ in some])
    first, owner = np.concatenate(([0], np.cumsum(sizes)[:-1])), np.repeat(np.arange(len(some)), sizes)
    y = np.array([v for _, v in some])
    pat = patches(rows)
    x = p["emb"][pat].reshape(-1, WIDTH * EMBED)
    z = (x @ p["filters"]).reshape(len(rows), _PATCHES, FILTERS)
    where = z.argmax(axis=1)
    top = np.take_along_axis(z, where[:, None], axis=1)[:, 0] + p["fbias"]
    vec = np.maximum(top, 0)
    high = np.maximum.reduceat(vec, first)
    feats = np.concatenate((high, np.add.reduceat(vec, first) / sizes[:, None]), axis=1)
    dz = ((sigmoid(feats @ p["unit"] + p["ubias"][0]) - y) * np.array([weight[v] for v in y]) / len(some)).astype(np.float32)
    out = {"unit": feats.T @ dz + 1e-4 * p["unit"], "ubias": dz.sum(keepdims=True)}
    dfeat = np.outer(dz, p["unit"])
    dvec = dfeat[owner, FILTERS:] / sizes[owner][:, None]
    best = vec == high[owner]  # chunks overlap, so several may hold the same best place
    dvec = dvec + dfeat[owner, :FILTERS] * best / np.add.reduceat(best.astype(np.float32), first)[owner]
    dvec = np.where(top > 0, dvec, 0).astype(np.float32)
    out["fbias"] = dvec.sum(axis=0)
    flat = (np.arange(len(rows))[:, None] * _PATCHES + where).ravel()
    col = np.tile(np.arange(FILTERS), len(rows))
    xs, g = x[flat], dvec.ravel()
    gf = np.zeros((FILTERS, WIDTH * EMBED), np.float32)
    np.add.at(gf, col, xs * g[:, None])
    out["filters"] = gf.T
    de = (g[:, None] * p["filters"].T[col]).reshape(-1, WIDTH, EMBED)
    ge = np.zeros_like(p["emb"])
    np.add.at(ge, pat.reshape(-1, WIDTH)[flat], de)
    ge[PAD] = 0
    out["emb"] = ge
    return out


def score_texts(model: dict, texts: list, at_once: int = 2048) -> np.ndarray:
    """Whole texts; at most about ``at_once`` chunks are in memory at a time, so a long text is pooled in parts."""
    out, own, count = np.zeros(len(texts)), [], 0

    def flush(upto: int) -> None:
        nonlocal own, count
        if own:
            sizes = [len(c) for c in own]
            rows = np.concatenate(own)
            vec = np.concatenate([pooled(model, rows[i : i + 256]) for i in range(0, len(rows), 256)])
            out[upto - len(own) : upto] = combine(model, vec, np.concatenate(([0], np.cumsum(sizes)[:-1])))
        own, count = [], 0

    for i, t in enumerate(texts):
        c = chunks((t or "").encode("utf-8", "replace"))
        if count + len(c) > at_once:
            flush(i)
        own.append(c)
        count += len(c)
    flush(len(texts))
    return out


def scored(docs: DataFrame, model: dict | None, name: str = "score") -> DataFrame:
    """``docs`` with ``name``: every text's probability of label 1. A column of that name is replaced."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)
    rows = docs.select(*[c for c in docs.columns if c.lower() != name])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            at = batch.schema.names.index("text")
            texts = batch.column(at).to_pylist()
            s = score_texts(shared.value, texts) if shared.value else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, name])

    schema = StructType(list(rows.schema.fields)).add(name, "double")
    return rows.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame) -> dict | None:
    """A model from documents outside fold 0 that have a label. Labels of one document are alike or the least counts."""
    marks = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    rows = training_rows(docs.select("doc_id", "text"), PER_LABEL, marks)
    return train(rows) if rows else None


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = learn(docs, labels)
    out = scored(docs.select("doc_id", "text"), model)
    # The text does not come back from Python.
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    name = "_quality_score"
    while name in map(str.lower, docs.columns):
        name += "_"
    rows = scored(docs, learn(docs, labels), name)
    return rows.filter(F.col(name) >= THRESHOLD).select(*docs.columns)
