import collections
import hashlib
import os

import numpy as np
import pytest
from test_operators import brute_components, brute_targets, low, words

import corpus_pipeline
from plexus.llm import mixing, pii, quality
from plexus.llm.common import scratch
from pyspark.sql import functions as F


def stages(spark, where):
    """The rows that go into each stage and those that come out of the last, each stage run as the pipeline runs it."""
    docs, seen = spark.read.parquet(f"{where}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs)
        path = scratch(spark, name)
        stage(spark, docs, where).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*seen, docs]


@pytest.fixture(scope="module")
def where(spark, clashing, rows, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('corpus')}"
    own = clashing.withColumn("text", F.when(F.col("doc_id") == 7, F.concat("text", F.lit(" mail me@a.b.org or 4111 1111 1111 1111"))).otherwise(F.col("text")))
    own.write.parquet(f"{at}/documents.parquet")
    marks = [(i, int(k % 3 > 0)) for k, (i, *_) in enumerate(rows) if i is not None and i < 40] + [(None, 1), (5, None)]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{at}/labels.parquet")
    return at


def count(df, columns):
    return collections.Counter(tuple(r) for r in df.select(*columns).collect())


def test_every_stage_is_the_plain_one(spark, where):
    docs, good, single, hidden, mixed, out = stages(spark, where)
    columns = docs.columns
    assert all(d.columns == columns for d in (good, single, hidden, mixed))

    # Documents that the model rejects go, with all their copies.
    model = quality.learn(docs, spark.read.parquet(f"{where}/labels.parquet"))
    plain = lambda t: float(quality.combine(model, quality.pooled(model, quality.chunks((t or "").encode())), np.array([0]))[0])
    at = columns.index("text")
    want = collections.Counter({r: n for r, n in count(docs, columns).items() if plain(r[at]) >= quality.THRESHOLD})
    assert count(good, columns) == want and 0 < sum(want.values()) < docs.count()

    # Exactly one row of each group of near duplicates, with the least id; rows without words stay.
    before = [tuple(r) for r in good.select("doc_id", "text").collect()]
    groups = collections.Counter()
    for i, t in [tuple(r) for r in single.select("doc_id", "text").collect()]:
        assert (i, t) in before
        groups[bool(words(low(t)))] += 1
    assert groups[False] == sum(not words(low(t)) for _, t in before)
    distinct = [(k, t) for k, t in enumerate(dict.fromkeys(t for _, t in before if words(low(t))))]
    assert groups[True] == len({c for _, _, c in brute_components(distinct)})
    least = {c for i, n, c in brute_components(before) if n and c is not None}
    assert {i for i, t in single.select("doc_id", "text").collect() if words(low(t)) and i is not None} == least

    # Personal data is hidden, all else stays.
    pattern = pii.compiled()
    assert count(hidden, ["doc_id", "text"]) == collections.Counter((r["doc_id"], pii.pseudonyms(r["text"], pii.KEY, pattern)[0]) for r in single.select("doc_id", "text").collect())

    # As many words of each source as its target.
    sizes, got = collections.Counter(), collections.Counter()
    for r in hidden.collect():
        sizes[r["source"]] += len(words(r["text"]))
    for r in mixed.collect():
        got[r["source"]] += len(words(r["text"]))
    assert {s: n for s, n in got.items() if n} == {s: int(t + 0.5) for s, t in brute_targets(sizes).items() if t}
    held = collections.Counter(r["doc_id"] for r in hidden.collect())
    assert all(n <= mixing.MAX_EPOCHS * held[i] for i, n in collections.Counter(r["doc_id"] for r in mixed.collect()).items())

    # Ids and texts as the library gives them.
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in mixed.select("doc_id", "text").collect():
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert count(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == want

    # run() gives the same and leaves the last output only.
    shared = spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0].removeprefix("file:")
    there = lambda: {d for d in os.listdir(shared) if d.startswith("plexus-")}
    old = there()
    assert count(corpus_pipeline.run(spark, where), out.columns) == count(out, out.columns)
    assert len(there() - old) == 1


def test_empty_tables_give_no_rows(spark, empty, tmp_path):
    at = f"file://{tmp_path}"
    empty.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{at}/labels.parquet")
    assert corpus_pipeline.run(spark, at).collect() == []
