"""Alignment of two tokenizers' tokens (operator 12).

Both tokenizers cut the same bytes. A token of A and one of B are linked if their byte ranges overlap; the links are the
edges of a bipartite graph whose connected components are the minimal groups of tokens that cover the same bytes. A task
gathers documents into blocks of about ``BLOCK_BYTES`` and runs a union-find over each block's tokens at once: every edge
hangs the larger root under the smaller one, pointers are halved until they rest, and this repeats until each edge has
one root. As edges follow the text, a few rounds do. The members of the components, in order, give the groups.

How many documents hold a pair of ids is counted in steps: within a block by sorting, then by Spark over the blocks'
distinct pairs. The counts go back to the blocks by a join on the pair, so rows are shuffled once per distinct pair of
a block, not of a document; a pair that all documents hold has one row a block. The highest count of each id of A has at
most as many rows as A's vocabulary, so it is sent to all tasks. A block meets its own counts in one task; its size is
bounded by ``BLOCK_BYTES`` and one document. Blocks are a written table, so lost executors cost single tasks.

Defined results: null and empty texts, and texts whose pieces do not join to the text with a space before it (those that
hold U+2581), have no tokens: zeros and an empty digest. Very long texts are encoded whole; the memory for one grows with
its length. Copies count as documents of their own, and so do rows with equal or null ids. An empty table gives no rows;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.bpe import byte_symbols
from plexus.llm.common import checkpoint, scratch
from plexus.llm.tokencount import BYTE_LEVEL, LONG_SPACE, _plain_byte_level

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
#: Distinct pairs of a block in one row.
PAIRS_A_ROW = 4096
#: Longer texts are given to the second tokenizer in parts, as its memory is about 150 times the text.
PART = 1 << 18
#: Where a text may be parted: no piece has a space behind another character, and letters and digits combine with nothing before them.
SEAM = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def byte_level(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder and tokens' bytes of a byte-level file; the strings of special tokens are plain text."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    raw = byte_symbols()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocabulary = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    of: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
    for s, i in vocabulary.items():
        of[i] = s.encode() if s in special else bytes(raw[c] for c in s)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = True
    slow = lambda t: library.encode(t, add_special_tokens=False).ids
    if not _plain_byte_level(spec):
        return slow, of
    own = tiktoken.Encoding("plain", pat_str=BYTE_LEVEL, mergeable_ranks={of[i]: i for s, i in spec["model"]["vocab"].items() if s not in special}, special_tokens={})
    return lambda t: slow(t) if LONG_SPACE.search(t) else own.encode_ordinary(t), of


def pieces(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """The same of a sentencepiece file, which puts a space before the text."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    of = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    whole_words = not any("▁" in p.lstrip("▁") for p in names)

    def encode(t: str) -> list[int]:
        if len(t) <= PART or not whole_words:
            return sp.encode(t, num_threads=1)
        out, at = [], 0
        while at < len(t):
            cut = SEAM.search(t, at + PART)
            stop = cut.start() if cut else len(t)
            out += sp.encode(t[at:stop], num_threads=1)
            at = stop + 1  # the space is put before the next part again
        return out

    return encode, of


@dataclass
class Tokenizers:
    """Two encoders, their tokens' bytes and lengths, and the ids as text with each mark that may follow."""

    encode_a: Callable[[str], list[int]]
    encode_b: Callable[[str], list[int]]
    bytes_a: list[bytes]
    bytes_b: list[bytes]

    def __post_init__(self):
        self.size_a, self.size_b = (np.array([len(x) for x in own], dtype=np.int64) for own in (self.bytes_a, self.bytes_b))
        self.shown_a = np.array([b"%d%b" % (i, m) for i in range(len(self.bytes_a)) for m in (b",", b"|")], dtype=object)
        self.shown_b = np.array([b"%d%b" % (i, m) for i in range(len(self.bytes_b)) for m in (b",", b";", b"")], dtype=object)

    @classmethod
    def named(cls, a: str = A, b: str = B) -> Tokenizers:
        import public_tokenizers

        (ea, oa), (eb, ob) = byte_level(public_tokenizers.path(a)), pieces(public_tokenizers.path(b))
        return cls(ea, eb, oa, ob)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both; none if the text is null or empty or either's bytes are not those of the text after a space."""
        if text:
            raw = f" {text}".encode()
            a, b = self.encode_a(f" {text}"), self.encode_b(text)
            if b"".join([self.bytes_a[i] for i in a]) == raw and b"".join([self.bytes_b[i] for i in b]) == raw:
                return np.array(a, dtype=np.int32), np.array(b, dtype=np.int32)
        return np.empty(0, np.int32), np.empty(0, np.int32)


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of A and B that overlap, by the offsets where tokens end: one link for each stretch without an end inside."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union-find: for each of n vertices the least one that edges (a, b) connect it with."""
    parent = np.arange(n)
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        low, high = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


@dataclass
class Block:
    """What a block's documents give. Arrays of documents first; ``at`` are the bounds of each one's pairs in ``pair`` and ``times``."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    at: np.ndarray
    pair: np.ndarray
    times: np.ndarray
    #: The block's distinct pairs, a * 2**32 + b, and how many of its documents hold each.
    codes: np.ndarray
    seen: np.ndarray


def aligned_block(own: list[tuple[np.ndarray, np.ndarray]], t: Tokenizers) -> Block:
    n_a, n_b = (np.array([len(x[i]) for x in own], dtype=np.int64) for i in (0, 1))
    a, b = (np.concatenate([x[i] for x in own]).astype(np.int64) for i in (0, 1))
    # The documents' bytes stand one behind the other; both tokenizers end at each document's end, so no link crosses it.
    la, lb = links(np.cumsum(t.size_a[a]), np.cumsum(t.size_b[b]))
    root = roots(len(a) + len(b), la, lb + len(a))
    is_root = root[: len(a)] == np.arange(len(a))  # a group's least vertex is a token of A
    number = np.cumsum(is_root) - 1
    group_a, group_b = number[root[: len(a)]], number[root[len(a) :]]
    doc_a, doc_b = np.repeat(np.arange(len(own)), n_a), np.repeat(np.arange(len(own)), n_b)
    doc_link = doc_a[la]
    # The text of the groups: a group's tokens of A, then those of B.
    in_a, in_b = np.bincount(group_a, minlength=is_root.sum()), np.bincount(group_b, minlength=is_root.sum())
    shown = np.empty(len(a) + len(b), dtype=object)
    shown[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = t.shown_a[2 * a + _last(group_a)]
    shown[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = t.shown_b[3 * b + _last(group_b) + _last(doc_b)]
    bounds = np.concatenate([[0], np.cumsum(n_a + n_b)])
    groups = [b"".join(shown[s:e].tolist()) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
    codes, which = np.unique((a[la] << 32) | b[lb], return_inverse=True)
    held, times = np.unique(doc_link * max(1, len(codes)) + which, return_counts=True)
    doc, pair = np.divmod(held, max(1, len(codes)))
    n = len(own)
    return Block(
        n_a, n_b, np.bincount(doc_a[is_root], minlength=n), np.bincount(doc_link, minlength=n), groups, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]),
        pair, times, codes, np.bincount(pair, minlength=len(codes)),
    )


def _last(numbers: np.ndarray) -> np.ndarray:
    """1 where the next number differs, and at the end."""
    return np.append(numbers[1:] != numbers[:-1], True).astype(np.int64)[: len(numbers)]


def _schema(kind: str) -> str:
    return f"block bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pair array<int>, times array<int>, base int, codes array<bigint>, seen array<int>"


_TYPES = [pa.int64(), None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())]


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def blocks(docs: DataFrame, a: str = A, b: str = B, digest: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows for documents (base null) and for the distinct pairs of their blocks (base not null), not yet written.

    groups: the text ``a1,a2|b1;a3|b2,b3``, or its digest.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t, number, ids, own, size = None, TaskContext.get().partitionId() << 32, [], [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            x, n = aligned_block(own, t), len(own)
            shown = [("" if not g else hashlib.sha256(g).hexdigest()) if digest else g.decode() for g in x.groups]
            columns = [[number] * n, ids, x.n_a, x.n_b, x.n_groups, x.n_links, shown]
            made = [pa.array(v, k) for v, k in zip(columns, kinds[:7], strict=True)] + [_lists(x.pair, x.at, pa.int32()), _lists(x.times, x.at, pa.int32())]
            yield pa.RecordBatch.from_arrays(made + [pa.nulls(n, k) for k in kinds[9:]], names)
            if len(x.codes):
                base = np.arange(0, len(x.codes), PAIRS_A_ROW)
                bounds, m = np.append(base, len(x.codes)), len(base)
                made = [pa.array([number] * m, pa.int64()), *[pa.nulls(m, k) for k in kinds[1:9]], pa.array(base, pa.int32())]
                yield pa.RecordBatch.from_arrays([*made, _lists(x.codes, bounds, pa.int64()), _lists(x.seen, bounds, pa.int32())], names)

        for batch in batches:
            kinds = [k or batch.schema.field("doc_id").type for k in _TYPES]
            t = t or Tokenizers.named(a, b)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(doc_id)
                own.append(t.tokens(text))
                size += len(text or "") + 64
                if size >= block_bytes:
                    yield from rows()
                    number, ids, own, size = number + 1, [], [], 0
        if own:
            yield from rows()

    names = [x.split()[0] for x in _schema(kind).split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, _schema(kind))


def pair_counts(rows: DataFrame) -> DataFrame:
    """code, a, b, n, best: how many documents hold each pair, and whether no pair of its a has more. ``rows``: those of ``blocks``."""
    each = rows.filter("base IS NOT NULL").select(F.inline(F.arrays_zip("codes", "seen")))
    totals = checkpoint(each.groupBy(F.col("codes").alias("code")).agg(F.sum("seen").alias("n")))
    totals = totals.select("code", F.shiftright("code", 32).cast("int").alias("a"), F.col("code").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "n")
    most = totals.groupBy("a").agg(F.max("n").alias("_most"))  # a row for each id of A at most
    return totals.join(F.broadcast(most), "a").select("code", "a", "b", "n", (F.col("n") == F.col("_most")).alias("best"))


def aligned(docs: DataFrame, a: str = A, b: str = B, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of documents (doc_id, text)."""
    spark, at, kind = docs.sparkSession, scratch(docs.sparkSession, "aligned"), docs.schema["doc_id"].dataType.simpleString()
    blocks(docs, a, b, block_bytes=block_bytes).write.parquet(at)
    rows = spark.read.parquet(at)
    counts = pair_counts(rows).select("code", "n", "best")
    asked = rows.filter("base IS NOT NULL").select("block", "base", F.posexplode("codes").alias("_pos", "code")).select("block", (F.col("base") + F.col("_pos")).alias("pos"), "code")
    known = asked.join(counts, "code").select("block", "pos", "n", "best")
    held = spark.read.parquet(at).filter("base IS NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pair", "times")

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        pos = right.column("pos").to_numpy()
        n, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        n[pos], best[pos] = right.column("n").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        pair, times = (left.column(c).combine_chunks() for c in ("pair", "times"))
        sizes = np.diff(pair.offsets.to_numpy())
        pair, times = pair.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        out = [np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)]
        for sums, of in zip(out, (best, n), strict=True):
            np.add.at(sums, doc, times * of[pair])
        first = [left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*first, pa.array(out[0]), pa.array(out[1]), left.column("groups")], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return held.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(scored, schema)
