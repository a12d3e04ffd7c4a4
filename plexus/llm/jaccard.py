"""N-gram Jaccard join (operator 7): a distributed prefix-tree join of word shingle sets.

1. Every text becomes a set of 64-bit shingle hashes. Equal sets are one class from here on, so copies cost nothing
   further. Two hashes name a class; classes that share the first are told apart by the second.
2. Shingles are counted by hash range, in compact blocks. Shingles of one class cannot be shared; they come first in the
   global order (rarest first, then by hash) and are never stored. Each task keeps a summary of its frequent shingles;
   those with a share of 1 / SUMMARY of all shingles, whose lists would outgrow a range, are found by it for certain,
   skip the ranges and come last in the order.
3. A class whose shared shingles number less than 75 % of its set has no partner and is dropped. The others keep
   their shared shingles in the global order. A class is listed under each of the first of them, as many as a partner
   may lack, with the largest partner that it may have if that shingle is the first one in common: what it lists before
   is lost, and so the overlap is at most what follows. Entries that allow no partner of their list's sizes go.
4. In every list the class that allows the largest partner leads. The leader traverses a prefix tree of the sets it leads
   (in blocks of about BLOCK shingles or BLOCK_SETS sets). The links found give components, so a group of near copies costs a row for
   each class and list, however many pairs it has.
5. Lists that hold two components still are open. Lists of equal members are one. In each, the sets outside its largest
   component traverse prefix trees of all its sets, both sides cut into blocks of about BLOCK shingles.
6. A prefix tree stores the sets of a block in the global order. Sets that traverse it gather the overlap of a shared path
   once, leave a subtree when what they have plus what can follow is less than the sizes demand, and skip subtrees
   whose sets all lie in their own component already.

No pair is emitted, no group is cut short, and each task holds two blocks or one hash range. What stays quadratic: sets
of one list that pass the size bounds, link with neither its leader nor each other, and so stay open.

Defined results: null and empty texts and texts without words have no shingles and are alone; a text of fewer than five
words is one shingle; very long texts are taken whole; rows of one doc_id are joined like others; rows with null doc_id
are joined, and a component's id is its least non-null doc_id; ties go to the larger class; repeated rows are one class;
an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import checkpoint, release, shuffle_partitions
from plexus.llm.components import components
from plexus.llm.textnum import batches, hashed_words, mix64, windows

SHINGLE = 5
#: A link needs NUMERATOR / DENOMINATOR at least.
NUMERATOR, DENOMINATOR = 3, 4
#: Shingles and sets of a block that is compared at once.
BLOCK = 1 << 18
BLOCK_SETS = 128
#: Cells of the table by which sets traverse a tree at once.
CELLS = 1 << 22
#: Entries of a task's summary of frequent shingles, and the frequent shingles of all at most.
SUMMARY = 1 << 16
MAX_FREQUENT = 1 << 20
FREQUENT = 1 << 30
#: Classes that a task remembers to have sent.
REMEMBER = 1 << 20
#: Keys of repeated rows that are sent to all tasks at most; more are joined by a shuffle.
MAX_HINTED = 100_000


def shingle_sets(texts: list) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first index, distinct shingles, where each text's begin (and the total), set sizes, two hashes of each set."""
    for at, own in batches(texts):
        h, bounds = hashed_words([b.lower() for b in own])
        win, text, _ = windows(h, bounds, SHINGLE, whole=True)
        order = np.lexsort((win, text))
        win, text = win[order], text[order]
        keep = np.ones(len(win), bool)
        keep[1:] = (win[1:] != win[:-1]) | (text[1:] != text[:-1])
        win, text = win[keep], text[keep]
        cuts = np.searchsorted(text, np.arange(len(own) + 1))
        n = np.diff(cuts)
        # Sums of mixed hashes name a set whatever the order.
        parts = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(win + np.uint64(k))))) for k in (1, 1 << 50)]
        sums = [p[cuts[1:]] - p[cuts[:-1]] for p in parts]
        cls, check = ((mix64(x) >> np.uint64(1)).astype(np.int64) for x in (sums[0] * np.uint64(0x9E3779B97F4A7C15) + sums[1], sums[1] + n.astype(np.uint64)))
        yield at, win, cuts, n, cls, check


class Frequent:
    """A Misra-Gries summary: what has a share of 1 / SUMMARY of all that was added is in it."""

    def __init__(self):
        self.item, self.count, self.seen, self.taken = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0

    def add(self, items: np.ndarray) -> None:
        self.seen += len(items)
        self.item, back = np.unique(np.concatenate((self.item, items)), return_inverse=True)
        self.count = np.bincount(back, np.concatenate((self.count, np.ones(len(items), np.int64))), len(self.item)).astype(np.int64)
        if len(self.item) > SUMMARY:
            least = np.partition(self.count, len(self.count) - SUMMARY - 1)[len(self.count) - SUMMARY - 1]
            keep = self.count > least
            self.item, self.count, self.taken = self.item[keep], self.count[keep] - least, self.taken + int(least)

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Items, and their counts at most."""
        often = self.count + self.taken >= max(8, self.seen // SUMMARY)
        return self.item[often], self.count[often] + self.taken


#: Shingles of a hash range on average, at most (about 300 MB in a worker while it is sorted).
RANGE_SHINGLES = 4_000_000


def _describe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows: all columns but the text, n_shingles, cls and check (null without shingles); and frequent shingles, as (cls: shingle, n_shingles: count)."""
    frequent, empty = Frequent(), None
    for batch in it:
        own = [c for c in batch.schema.names if c != "text"]
        names = [*own, "n_shingles", "cls", "check", "is_shingle"]
        for at, win, cuts, n, cls, check in shingle_sets(batch.column("text").to_pylist()):
            ids = [batch.column(c).slice(at, len(n)) for c in own]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(n, pa.int64()), pa.array(cls, mask=n == 0), pa.array(check, mask=n == 0), pa.array(np.zeros(len(n), bool))], names)
            _, first = np.unique(cls, return_index=True)
            alone = np.zeros(len(n), bool)
            alone[first] = True
            frequent.add(win[np.repeat(alone, n)])
            empty = [x.type for x in ids]
    item, count = frequent.found()
    for i in range(0, len(item), 1 << 16):
        some = item[i : i + (1 << 16)]
        k = len(some)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(k, t) for t in empty], pa.array(count[i : i + k], pa.int64()), pa.array(some.view(np.int64)), pa.nulls(k, pa.int64()), pa.array(np.ones(k, bool))], names)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    start = _starts(keys)
    return zip(start.tolist(), np.append(start[1:], len(keys)).tolist() if len(keys) else [], strict=True)


def _pack(cls: np.ndarray, n: np.ndarray, tok: np.ndarray) -> bytes:
    """Postings sorted by class as class, set size and count per class, and eight bytes per shingle."""
    start = _starts(cls)
    count = np.diff(np.append(start, len(cls)))
    head = np.array([len(start), len(tok)], np.int64)
    return head.tobytes() + cls[start].tobytes() + n[start].astype(np.int32).tobytes() + count.astype(np.int32).tobytes() + tok.tobytes()


def _unpack(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k, m = map(int, np.frombuffer(b, np.int64, 2))
    cls = np.frombuffer(b, np.int64, k, 16)
    n = np.frombuffer(b, np.int32, k, 16 + 8 * k)
    count = np.frombuffer(b, np.int32, k, 16 + 12 * k)
    return np.repeat(cls, count), np.repeat(n, count), np.frombuffer(b, np.uint64, m, 16 + 16 * k)


def _by_key(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blocks of each key from rows sorted by key; one key is in memory at a time."""
    key, own = None, []
    for batch in it:
        for k, b in zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if k != key and own:
                yield key, own
                own = []
            key = k
            own.append(b)
    if own:
        yield key, own


def _rows(keys: list, blocks: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blocks, pa.binary())], ["key", "block"])


def _dealt(df: DataFrame, labels: list[int]) -> DataFrame:
    return df.repartition(len(labels), "key").sortWithinPartitions("key")


def _labels(spark, n: int) -> list[int]:
    """A key for each of n partitions that a hash partitioning sends there."""
    part = F.pmod(F.hash(F.col("id")), F.lit(n)).alias("p")
    got = spark.range(40 * n + 100).select("id", part).groupBy("p").agg(F.min("id").alias("id")).collect()  # n rows
    found = {r["p"]: r["id"] for r in got}
    return [found.get(i, i) for i in range(n)]


def _holds(found: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted ``found``."""
    if not len(found):
        return np.zeros(len(values), bool)
    return found[np.minimum(np.searchsorted(found, values), len(found) - 1)] == values


def shared_shingles(docs: DataFrame, described: DataFrame, doubled: np.ndarray) -> DataFrame:
    """cls, n, r, tok, df: classes that may have partners, with their shared shingles in the global order."""
    spark = docs.sparkSession
    total = described.filter("not is_shingle").agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("t")).first()["t"]
    # A range is sorted in one worker's memory, so their number grows with the shingles.
    labels = _labels(spark, max(shuffle_partitions(spark), -(-total // RANGE_SHINGLES)))
    parts = len(labels)
    often = described.filter("is_shingle").groupBy("cls").agg(F.sum("n_shingles").alias("c")).filter(F.col("c") >= max(16, total // MAX_FREQUENT))
    # Each holds a share of about 1 / MAX_FREQUENT of all shingles at least, which bounds their number.
    frequent = spark.sparkContext.broadcast(np.sort(np.array([r["cls"] for r in often.select("cls").collect()], np.int64).view(np.uint64)))

    def post(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in it:
            for _, win, cuts, n, cls, check in shingle_sets(batch.column("text").to_pylist()):
                cls = np.where(_holds(doubled, cls), check, cls)
                fresh = np.zeros(len(n), bool)
                for i, c in enumerate(cls.tolist()):
                    if c not in seen and n[i]:
                        seen.add(c)
                        fresh[i] = True
                if len(seen) > REMEMBER:  # what is sent twice is counted once all the same
                    seen.clear()
                keep = np.repeat(fresh, n)
                tok, own = win[keep], np.repeat(np.arange(len(n)), n)[keep]
                bucket = np.where(_holds(frequent.value, tok), parts + cls[own] % parts, (mix64(tok) % np.uint64(parts)).astype(np.int64))
                order = np.lexsort((own, bucket))
                tok, own, bucket = tok[order], own[order], bucket[order]
                keys, blocks = [], []
                for a, b in _runs(bucket):
                    k = int(bucket[a])
                    keys.append(labels[k] if k < parts else -1 - labels[k - parts])
                    blocks.append(_pack(cls[own[a:b]], n[own[a:b]], tok[a:b]))
                if keys:
                    yield _rows(keys, blocks)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From shingle ranges to classes: shingles of two classes at least, with their counts."""
        for key, own in _by_key(it):
            cls, n, tok = (np.concatenate(x) for x in zip(*map(_unpack, own), strict=True))
            if key < 0:
                df = np.full(len(tok), FREQUENT, np.int64)
            else:
                order = np.lexsort((cls, tok))
                cls, n, tok = cls[order], n[order], tok[order]
                new = np.ones(len(tok), bool)
                new[1:] = (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])
                cls, n, tok = cls[new], n[new], tok[new]
                size = np.diff(np.append(_starts(tok), len(tok)))
                df = np.repeat(size, size)
                shared = df > 1
                cls, n, tok, df = cls[shared], n[shared], tok[shared], df[shared]
            to = cls % parts
            order = np.lexsort((cls, to))
            cls, n, tok, df, to = cls[order], n[order], tok[order], df[order], to[order]
            keys, blocks = [], []
            for a, b in _runs(to):
                keys.append(labels[int(to[a])])
                blocks.append(_pack(cls[a:b], n[a:b], tok[a:b]) + np.minimum(df[a:b], FREQUENT).astype(np.int32).tobytes())
            if keys:
                yield _rows(keys, blocks)

    def gather(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per class its shared shingles, if they are enough for a partner."""
        for _, own in _by_key(it):
            got = []
            for b in own:
                cls, n, tok = _unpack(b)
                got.append((cls, n, tok, np.frombuffer(b, np.int32, len(tok), len(b) - 4 * len(tok))))
            cls, n, tok, df = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.lexsort((tok, df, cls))
            cls, n, tok, df = cls[order], n[order], tok[order], df[order]
            new = np.ones(len(tok), bool)
            new[1:] = (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])
            cls, n, tok, df = cls[new], n[new], tok[new], df[new]
            enough = [(a, b) for a, b in _runs(cls) if (b - a) * DENOMINATOR >= int(n[a]) * NUMERATOR]
            for i in range(0, len(enough), 1000):
                some = enough[i : i + 1000]
                first = [a for a, _ in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[first]), pa.array(n[first], pa.int32()), pa.array([b - a for a, b in some], pa.int32()), pa.array([tok[a:b].tobytes() for a, b in some], pa.binary()), pa.array([df[a:b].tobytes() for a, b in some], pa.binary())],
                    ["cls", "n", "r", "tok", "df"],
                )

    posted = docs.select("text").mapInArrow(post, "key bigint, block binary")
    counted = _dealt(posted, labels).mapInArrow(count, "key bigint, block binary")
    return checkpoint(_dealt(counted, labels).mapInArrow(gather, "cls bigint, n int, r int, tok binary, df binary"))


def _entries(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """p, cls, n and most: the size of the largest partner whose first shingle in common is p."""
    for batch in it:
        own = [batch.column(i).to_pylist() for i in range(4)]
        for i in range(0, len(own[0]), 200):
            cls, tok, size, most = [], [], [], []
            for c, n, r, t in zip(*(x[i : i + 200] for x in own), strict=True):
                need = -(-NUMERATOR * n // DENOMINATOR)
                k = r - need + 1
                tok.append(np.frombuffer(t, np.int64)[:k])
                cls.append(np.full(k, c))
                size.append(np.full(k, n, np.int64))
                most.append((NUMERATOR + DENOMINATOR) * (r - np.arange(k)) // NUMERATOR - n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (tok, cls, size, most)], ["p", "cls", "n", "most"])


def needed(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """The least overlap of a link between sets of these sizes."""
    return -(-NUMERATOR * (n1 + n2) // (NUMERATOR + DENOMINATOR))


class Sets:
    """The shared shingles of a block's classes and the components that they lie in (each its own where none is given)."""

    def __init__(self, rows: list[dict]):
        self.comp = np.array([x["comp"] if "comp" in x else x["cls"] for x in rows], np.int64)
        self.n = np.array([x["n"] for x in rows], np.int64)
        self.tok = [np.frombuffer(x["tok"], np.uint64) for x in rows]
        self.df = [np.frombuffer(x["df"], np.int32) for x in rows]


def _ordered(a: Sets, b: Sets) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """The sets by numbers in the global order of the two blocks' shingles, and how many there are."""
    tok = np.concatenate(a.tok + b.tok)
    df = np.concatenate(a.df + b.df)
    _, first, back = np.unique(tok, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.lexsort((tok[first], df[first]))] = np.arange(len(first))
    parts = np.split(rank[back], np.cumsum([len(t) for t in a.tok + b.tok])[:-1])
    return parts[: len(a.tok)], parts[len(a.tok) :], len(first)


class Tree:
    """The sets of a block as a compressed prefix tree: sorted, a subtree is a run of them that agree on a prefix."""

    def __init__(self, sets: Sets, right: list[np.ndarray]):
        order = sorted(range(len(right)), key=lambda j: right[j].astype(">u4").tobytes())
        self.place = np.array(order, np.int64)
        self.sets = [right[j] for j in order]
        self.size = np.array([len(x) for x in self.sets], np.int64)
        self.n, self.comp = sets.n[self.place], sets.comp[self.place]
        self._mark()

    def _mark(self) -> None:
        self.changes = np.flatnonzero(self.comp[1:] != self.comp[:-1]) + 1

    def merge(self, old: int, new: int) -> None:
        self.comp[self.comp == old] = new
        self._mark()

    def one_component(self, lo: int, hi: int) -> bool:
        k = int(np.searchsorted(self.changes, lo, "right"))
        return k == len(self.changes) or int(self.changes[k]) >= hi


def tree_links(a: Sets, b: Sets, thin: bool = False) -> list[tuple[int, int]]:
    """Positions (in a, in b) of all links. The sets of ``b`` form a prefix tree; those of ``a`` traverse it together.

    thin: links between components that are not joined yet only; ``a.comp`` is changed as they are joined.
    """
    left, right, width = _ordered(a, b)
    tree, links = Tree(b, right), []
    step = max(1, CELLS // (width + 1))
    for i in range(0, len(left), step):
        links += _traverse(a, np.arange(i, min(i + step, len(left))), left, tree, width, thin)
    return links


def _traverse(a: Sets, some: np.ndarray, left: list[np.ndarray], tree: Tree, width: int, thin: bool) -> list[tuple[int, int]]:
    has = np.zeros((len(some), width + 1), np.int32)
    for k, i in enumerate(some.tolist()):
        has[k, left[i] + 1] = 1
    upto = np.cumsum(has, axis=1, dtype=np.int32)  # upto[k, x]: shingles of a set below number x
    size, n = upto[:, -1], a.n[some]
    links: list[tuple[int, int]] = []
    stack = [(0, len(tree.sets), 0, np.arange(len(some)), np.zeros(len(some), np.int64))]
    while stack:
        lo, hi, depth, who, got = stack.pop()
        if thin and tree.one_component(lo, hi):
            other = a.comp[some[who]] != tree.comp[lo]
            who, got = who[other], got[other]
        one, last = tree.sets[lo], tree.sets[hi - 1]
        m = min(len(one), len(last))
        differ = np.flatnonzero(one[depth:m] != last[depth:m])
        end = depth + int(differ[0]) if differ.size else m
        if end > depth and who.size:
            got = got + has[who[:, None], one[depth:end] + 1].sum(axis=1)
        after = one[end - 1] + 1 if end else 0
        can = got + np.minimum(size[who] - upto[who, after], tree.size[lo:hi].max() - end)
        keep = can >= needed(n[who], tree.n[lo:hi].min())
        who, got = who[keep], got[keep]
        if not who.size:
            continue
        k = lo
        while k < hi and tree.size[k] == end:
            for i in some[who[got >= needed(n[who], tree.n[k])]].tolist():
                u, v = int(a.comp[i]), int(tree.comp[k])
                if not thin:
                    links.append((i, int(tree.place[k])))
                elif u != v:
                    links.append((i, int(tree.place[k])))
                    a.comp[a.comp == v] = u
                    tree.merge(v, u)
            k += 1
        while k < hi:
            nxt = tree.sets[k][end]
            stop = k + 1
            while stop < hi and tree.sets[stop][end] == nxt:
                stop += 1
            stack.append((k, stop, end, who, got))
            k = stop
    return links


def _compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components found by the sets of side 0 in the tree of side 1; rows are sorted by task."""

    def run(rows: list[dict]) -> pa.RecordBatch:
        a, b = (Sets([x for x in rows if x["side"] == s]) for s in (0, 1))
        of = a.comp.copy(), b.comp.copy()
        links = tree_links(a, b, thin=True) if len(a.n) and len(b.n) else []
        return pa.RecordBatch.from_arrays([pa.array([int(of[s][x[s]]) for x in links], pa.int64()) for s in (0, 1)], ["a", "b"])

    task, rows = None, []
    for batch in it:
        for x in batch.to_pylist():
            if (x["k"], x["i"], x["j"]) != task and rows:
                yield run(rows)
                rows = []
            task = (x["k"], x["i"], x["j"])
            rows.append(x)
    if rows:
        yield run(rows)


def _compared(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) of components, from rows (k, i, j: the task; side, cls, comp). Each task's sets go to it once."""
    full = rows.join(sets.select("cls", "n", "tok", "df"), "cls").select("k", "i", "j", "side", "comp", "n", "tok", "df")
    return checkpoint(full.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j").mapInArrow(_compare, "a bigint, b bigint"))


def _blocks(weight: Column, sets: Column) -> Column:
    return F.ceil(F.greatest(weight / BLOCK, sets / BLOCK_SETS)).cast("int")


def _block_of(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("cls", F.lit("block")), blocks).cast("int")


def _each(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def class_components(sets: DataFrame) -> DataFrame:
    """cls and label for classes that link with another one."""
    entries = checkpoint(sets.select("cls", "n", "r", "tok").mapInArrow(_entries, "p bigint, cls bigint, n bigint, most bigint"))
    lists = entries.groupBy("p").agg(F.count("*").alias("c"), F.min("n").alias("least")).filter("c > 1")
    useful = checkpoint(entries.join(lists, "p").filter("most >= least").select("p", "cls", "n", "most"))

    lead = useful.groupBy("p").agg(F.max(F.struct("most", "cls"))["cls"].alias("k"))
    led = checkpoint(useful.join(lead, "p").filter("cls != k").groupBy("k", "cls").agg(F.first("n").alias("n")))
    blocks = led.groupBy("k").agg(_blocks(F.sum("n"), F.count("*")).alias("blocks"))
    none = F.lit(0).alias("i")
    trees = led.join(blocks, "k").select("k", none, _block_of(F.col("blocks")).alias("j"), F.lit(1).alias("side"), "cls", F.col("cls").alias("comp"))
    probes = blocks.select("k", none, _each(F.col("blocks")).alias("j"), F.lit(0).alias("side"), F.col("k").alias("cls"), F.col("k").alias("comp"))
    stars = components(_compared(trees.unionByName(probes), sets))

    placed = useful.join(stars.withColumnRenamed("v", "cls"), "cls", "left").withColumn("comp", F.coalesce("label", "cls")).drop("label")
    mark = [F.sum(F.xxhash64("cls", F.lit(x)).cast("decimal(20,0)")).alias(x) for x in ("s", "t")]
    open_lists = placed.groupBy("p").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"), *mark).filter("lo != hi")
    # Lists of the same members need one comparison.
    kept = open_lists.groupBy("c", "s", "t", "lo", "hi").agg(F.min("p").alias("p")).select("p")
    members = checkpoint(placed.join(kept, "p"))
    sizes = members.groupBy("p", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    largest = sizes.groupBy("p").agg(F.max(F.struct("m", "w", "comp")).alias("b"), F.sum("w").alias("w"), F.sum("m").alias("m"))
    cut = largest.select("p", F.col("b.comp").alias("giant"), _blocks(F.col("w"), F.col("m")).alias("trees"), _blocks(F.col("w") - F.col("b.w"), F.col("m") - F.col("b.m")).alias("probes"))
    both = members.join(cut, "p")
    trees = both.select(F.col("p").alias("k"), _each(F.col("probes")).alias("i"), _block_of(F.col("trees")).alias("j"), F.lit(1).alias("side"), "cls", "comp")
    probes = both.filter("comp != giant").select(F.col("p").alias("k"), _block_of(F.col("probes")).alias("i"), _each(F.col("trees")).alias("j"), F.lit(0).alias("side"), "cls", "comp")
    joined = components(_compared(trees.unionByName(probes), sets))
    ends = stars.select("v", "label").union(joined.join(stars.select(F.col("label").alias("v")).distinct(), "v", "left_anti").select("v", F.col("v").alias("label")))
    return ends.join(joined.select(F.col("v").alias("label"), F.col("label").alias("far")), "label", "left").select(F.col("v").alias("cls"), F.coalesce("far", "label").alias("label"))


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All columns of ``docs`` but the text, n_shingles and cls of every row; cls and label, its component, of every class."""
    own = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text")
    described = checkpoint(docs.mapInArrow(_describe, f"{own}, n_shingles bigint, cls bigint, check bigint, is_shingle boolean"))
    rows = described.filter("not is_shingle").drop("is_shingle")
    # Different sets under one first hash: at most a handful among billions.
    twice = rows.filter("cls is not null").groupBy("cls").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).filter("lo != hi")
    doubled = np.sort(np.array([r["cls"] for r in twice.select("cls").collect()], np.int64))
    if len(doubled):
        rows = rows.withColumn("cls", F.when(F.col("cls").isin(doubled.tolist()), F.col("check")).otherwise(F.col("cls")))
    rows = rows.drop("check")
    sets = shared_shingles(docs, described, doubled)
    release(docs.sparkSession)  # of the postings
    labels = checkpoint(class_components(sets))
    release(docs.sparkSession)  # of the comparisons
    classes = rows.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    return rows, classes.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows, named = grouped(docs.select("doc_id", "text"))
    groups = named.groupBy("label").agg(F.min("least").alias("component_id"))
    component = named.join(groups, "label").select("cls", "component_id")
    return rows.join(component, "cls", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: exactly one of each group of near duplicates, and every row without words.

    Of a group stays the row of the least doc_id (null comes last), then by digests of the text and of the whole row;
    of rows that are equal in all columns stays any one.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    rows = rows.select("_row", F.unhex(F.md5(F.to_json("_row"))).alias("_k"))
    own, named = grouped(rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text"), F.unhex(F.md5("_row.text")).alias("t"), F.col("_k").alias("k")))
    labelled = own.join(checkpoint(named.select("cls", "label")), "cls", "left").drop("cls", "n_shingles")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t", "k")
    best = labelled.filter("label is not null").groupBy("label").agg(F.min(order)["k"].alias("_k")).select("_k")
    several = own.groupBy(F.col("k").alias("_k")).agg(F.count("*").alias("n")).filter("n > 1").select("_k", F.lit(True).alias("repeats"))
    chosen = best.join(several, "_k", "left").select("_k", F.coalesce("repeats", F.lit(False)).alias("repeats"))
    stay = checkpoint(chosen.union(labelled.filter("label is null").select("k", F.lit(False)).distinct()))
    repeats = stay.filter("repeats").select("_k")
    many = repeats.count()
    kept = rows.join(stay.filter("not repeats").select("_k"), "_k").select("_row")
    if many:
        found = rows.join(F.broadcast(repeats) if many <= MAX_HINTED else repeats, "_k")
        kept = kept.union(found.groupBy("_k").agg(F.first("_row").alias("_row")).select("_row"))
    return kept.select("_row.*")
