"""Token counts (operator 4) with a digest cache.

Every text is keyed by the digest of its normalised content (null becomes the empty text; nothing else may change, since
counts are exact) and the digest of the tokenizer file. Digests are joined to stored counts; only distinct contents
without a count are encoded; their counts are appended to the cache, from which all rows then get theirs. Texts are
thinned to one per digest on the map side, before they are shuffled, so copies cost nothing further.

The cache is a shared folder for all corpora, with a folder for each tokenizer digest, so only one tokenizer's counts are
read. Every append is written to a hidden folder of its own, which gets its name when the job is complete, so jobs that
append at once do not touch each other's files, and lost executors or drivers leave no partial rows. Counts never go
stale, as a digest names content and tokenizer; a digest that two jobs append is in the cache twice and read once. Files
that are gone are counted anew by the next run; a cache that cannot be read, and a row without a count, are errors.

Defined results: null and empty texts have 0 bytes and 0 tokens; very long texts are encoded whole; repeated rows share a
count; a count equal to the limit is not over it; an empty table gives no rows and appends nothing; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.llm.bpe import Encoder, Vocabulary, byte_symbols
from plexus.llm.common import checkpoint

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
_CACHE = "digest binary, n_tokens bigint"
#: Digests that are sent to all tasks at most (4 MB); more are joined by a shuffle.
MAX_HINTED = 100_000
#: White space that the faster encoder is not given: its pattern needs a stack as deep as the run.
LONG_SPACE = re.compile(r"\s{4096}")
#: The pre-tokenizer of byte-level files, fixed.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def file_digest(name: str) -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _plain_byte_level(spec: dict) -> bool:
    """Whether the file is byte-level BPE whose ids follow its merges, with no step besides."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens", [])
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer")
    plain = plain and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
    return bool(plain) and all(model["vocab"][m] == 256 + i for i, m in enumerate(merges))


def counter(name: str) -> Callable[[str], int]:
    """Counts a text's tokens as the file's library does. Plain byte-level files are read into a faster encoder of the same result."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        return lambda t, p=sentencepiece.SentencePieceProcessor(model_file=path): len(p.encode(t))
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if _plain_byte_level(spec):
        import tiktoken

        raw = byte_symbols()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(raw[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        own = tiktoken.Encoding("plain", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)
        spare: list[Encoder] = []

        def count(t: str) -> int:
            if LONG_SPACE.search(t):
                if not spare:
                    spare.append(Encoder(Vocabulary(path)))
                return sum(len(ids) for ids in spare[0].encode([t]))
            return len(own.encode(t, allowed_special="all") if any(s in t for s in special) else own.encode_ordinary(t))

        return count
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def _place(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """digest and n_tokens, one row per digest. Only the tokenizer's own folder is read; appends that are not complete are hidden."""
    files, at = _place(spark, f"{path}/{tokenizer}")
    if not files.exists(at):
        return spark.createDataFrame([], _CACHE)
    rows = spark.read.schema(_CACHE).option("recursiveFileLookup", "true").parquet(f"{path}/{tokenizer}")
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append(counts: DataFrame, path: str, tokenizer: str) -> None:
    """Writes ``counts`` (digest, n_tokens) to a folder of its own and names it when it is complete."""
    spark, name = counts.sparkSession, uuid.uuid4().hex
    counts.write.parquet(f"{path}/{tokenizer}/_{name}")
    files, at = _place(spark, f"{path}/{tokenizer}/_{name}")
    if not files.rename(at, _place(spark, f"{path}/{tokenizer}/{name}")[1]):
        raise OSError(f"{at} cannot be renamed")


def append_misses(docs: DataFrame, path: str, name: str) -> None:
    """Counts the contents of ``docs`` that the cache at ``path`` lacks, and appends them to it."""
    spark, tokenizer = docs.sparkSession, file_digest(name)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(_digest(text).alias("digest"), text.alias("text"))
    # Digests alone are looked up first, so texts that have a count are not moved.
    missing = checkpoint(keyed.select("digest").distinct().join(read_cache(spark, path, tokenizer), "digest", "left_anti"))
    n = missing.count()
    if not n:
        return
    if n <= MAX_HINTED:
        contents = keyed.join(F.broadcast(missing), "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    else:
        contents = keyed.groupBy("digest").agg(F.first("text").alias("text")).join(missing, "digest", "left_semi")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in it:
            count = count or counter(name)
            n = [count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    append(contents.mapInArrow(run, _CACHE), path, tokenizer)


def _digest(text):
    return F.unhex(F.sha2(text, 256))


def counted(docs: DataFrame, counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row by counts (digest, n_tokens); a row without a count is an error."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), _digest(text).alias("digest"))
    n = F.coalesce("n_tokens", F.raise_error(F.concat(F.lit("no count is stored for "), F.hex("digest"))).cast("bigint"))
    return keyed.join(counts, "digest", "left").select("doc_id", "n_bytes", n.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)


def token_counts(docs: DataFrame, path: str, name: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """The same by the cache at ``path``, which is filled first."""
    append_misses(docs, path, name)
    # Written out, so that both sides of the join are plain exchanges and a digest that many rows share can be split.
    return counted(docs, checkpoint(read_cache(docs.sparkSession, path, file_digest(name))), limit)
