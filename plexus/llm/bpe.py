"""BPE encoding and decoding (operator 1), byte-level.

The words of a batch are found in numpy, and only words not met before in the partition are merged. They are laid end
to end, and an index maps each pair that has a merge to all its positions. Active ranks are applied in ascending order:
all positions of the lowest active rank are merged at once, and the lists of the pairs beside them are updated. A pair
that holds a merge's result has a higher rank than the merge, so each rank is applied once.

Words merged so far are kept per partition, by their letters, up to ``REMEMBER`` words or eight times as many ids; beyond
that the memory starts anew, which changes nothing in the results. Words of a run are sorted by a hash and then compared
letter by letter, so a word never takes another one's ids.

Defined results: null and empty texts have no tokens and decode to the empty text; very long texts are encoded whole;
repeated rows are alike; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plexus.llm.textnum import span_ids

VOCABULARY = "byte_bpe_50k.json"
REMEMBER = 400_000
#: Characters cut into words at once, and characters whose new words are merged at once.
AT_ONCE = 1 << 20
MERGE_ONCE = 8 << 20

LETTER, NUMBER, SPACE, OTHER, EDGE = range(5)
_EDGE_CODE = 0x110000
_CUT = re.compile(r"(?<=[a-z]) (?=[a-z])")


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def char_class(c: str) -> int:
    kind = unicodedata.category(c)
    if kind[0] == "L":
        return LETTER
    if kind[0] == "N":
        return NUMBER
    return SPACE if kind[0] == "Z" or c in "\t\n\x0b\x0c\r\x85" else OTHER


class Vocabulary:
    """Tables of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, raw = spec["model"], byte_symbols()
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1 + len(spec.get("added_tokens", []))
        self.bytes: list[bytes] = [b""] * self.size
        for s, i in vocab.items():
            self.bytes[i] = bytes(raw[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.of_byte = np.zeros(256, np.int64)
        for s, b in raw.items():
            self.of_byte[b] = vocab[s]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left * self.size + self.right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.low = np.array([char_class(chr(c)) for c in range(0x3000)], np.uint8)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, -1 without one."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def classes(self, codes: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(codes, len(self.low) - 1)]
        high = np.flatnonzero(codes >= len(self.low))
        if high.size:
            some, back = np.unique(codes[high], return_inverse=True)
            out[high] = np.array([EDGE if c == _EDGE_CODE else char_class(chr(c)) for c in some], np.uint8)[back]
        return out


def word_starts(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where words begin in texts laid end to end, each followed by an edge code (which begins a word of its own).

    A run of letters, numbers or other characters is a word, with one blank before it if there is one. White space
    before a word is split before its last character; at a text's end it stays together. A quote in front of s, t, m,
    d, re, ve or ll, unless a blank or other characters stand before it, begins a word that ends with them.
    """
    n = len(codes)
    before = np.concatenate(([EDGE], kind[:-1]))
    after = np.concatenate((kind[1:], [EDGE]))
    changed = kind != before
    blank_before = np.concatenate(([False], codes[:-1] == 32))
    space = kind == SPACE
    start = changed & ~(blank_before & ~space)
    start |= space & (after != SPACE) & (after != EDGE)
    start |= kind == EDGE
    start[np.flatnonzero(kind == EDGE)[:-1] + 1] = True
    if n:
        start[0] = True
    quote = np.flatnonzero((codes == 39) & changed & ~blank_before & (after == LETTER))
    if quote.size:
        c1 = codes[np.minimum(quote + 1, n - 1)]
        c2 = codes[np.minimum(quote + 2, n - 1)]
        one = np.isin(c1, [ord(c) for c in "stmd"])
        two = ((c2 == ord("e")) & ((c1 == ord("r")) | (c1 == ord("v")))) | ((c1 == ord("l")) & (c2 == ord("l")))
        quote, length = quote[one | two], np.where(one, 2, 3)[one | two]
        start[quote + 1] = False
        stop = quote + length
        # What follows begins a word, except white space, which has its own rule.
        stop = stop[~space[stop]]
        start[stop] = True
    return np.flatnonzero(start)


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, end to end, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    n = len(data)
    sym = v.of_byte[data]
    ends = np.cumsum(sizes)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[ends - 1] = -1
    prv[ends[:-1]] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(at: np.ndarray) -> None:
        """Puts the pairs that begin at these positions into the index; a position twice in a list does no harm."""
        r = v.rank(sym[at], sym[nxt[at]])
        at, r = at[r >= 0], r[r >= 0]
        if not at.size:
            return
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for rank, part in zip(r[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(active, rank)

    add(np.flatnonzero(nxt >= 0))
    while active:
        rank = heapq.heappop(active)
        parts = index.pop(rank)
        at = parts[0] if len(parts) == 1 else np.concatenate(parts)
        a, b, made = v.left[rank], v.right[rank], v.made[rank]
        to = nxt[at]
        at = at[(sym[at] == a) & (to >= 0) & (sym[to] == b)]
        if a == b and at.size > 1:
            at = np.sort(at)
            kept, used = [], -1
            for p, q in zip(at.tolist(), nxt[at].tolist(), strict=True):
                if p != used:
                    kept.append(p)
                    used = q
            at = np.array(kept)
        if not at.size:
            continue
        gone = nxt[at]
        after = nxt[gone]
        sym[at] = made
        sym[gone] = -1
        nxt[gone] = -1
        nxt[at] = after
        prv[after[after >= 0]] = at[after >= 0]
        left = prv[at]
        near = np.concatenate((left[left >= 0], at[after >= 0]))
        if near.size:
            add(near)
    live = sym >= 0
    count = np.add.reduceat(live.astype(np.int64), np.concatenate(([0], ends[:-1]))) if n else np.zeros(0, np.int64)
    return sym[live], count


class Encoder:
    """Encodes batches of texts; remembers the words it has merged."""

    def __init__(self, v: Vocabulary, remember: int = REMEMBER):
        self.v, self.remember = v, remember
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _look_up(self, text: str, codes: np.ndarray, start: np.ndarray, end: np.ndarray, new_words: list[bytes]) -> np.ndarray:
        """The number of each word in memory; words that are new get the next numbers and join ``new_words``."""
        number, first = span_ids(codes, start, end)
        known = self.known
        words = [text[i:j] for i, j in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        at = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
        new = np.flatnonzero(at < 0)
        if new.size:
            at[new] = np.arange(len(known), len(known) + len(new))
            fresh = [words[i] for i in new.tolist()]
            known.update(zip(fresh, at[new].tolist(), strict=True))
            new_words += [w.encode() for w in fresh]
        return at[number]

    def _words(self, texts: list[str], new_words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of texts without special tokens, and where each text's end."""
        joined = "\x00".join(texts) + "\x00"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        codes[ends - 1] = _EDGE_CODE
        kind = self.v.classes(codes)
        begin = word_starts(codes, kind)
        end = np.append(begin[1:], len(codes))
        real = kind[begin] != EDGE
        begin, end = begin[real], end[real]
        word = self._look_up(joined, codes, begin, end, new_words) if begin.size else np.zeros(0, np.int32)
        return word, np.searchsorted(begin, ends)

    def _expand(self, word: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
        """The ids of each text from its word numbers."""
        count = self.count[word]
        total = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[word] - (total - count), count) + np.arange(total[-1] if len(total) else 0)]
        return np.split(ids, np.concatenate(([0], total))[stops][:-1])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; strings of special tokens become their ids.

        Texts are cut into words in runs of AT_ONCE characters; the words that are new in MERGE_ONCE characters are merged together.
        """
        own: list[str] = []
        runs: list[tuple[np.ndarray, np.ndarray]] = []
        new_words: list[bytes] = []
        plan: list[list] = []  # per text: None for a piece, in order, or ids of special tokens
        size = done = 0

        def cut() -> None:
            if own:
                runs.append(self._words(own, new_words))
                own.clear()

        def flush() -> Iterator[np.ndarray]:
            cut()
            if new_words:
                ids, count = merge_words(new_words, self.v)
                self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(count) - count))
                self.count = np.concatenate((self.count, count))
                self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
                new_words.clear()
            pieces = (p for run in runs for p in self._expand(*run))
            for parts in plan:
                found = [next(pieces) if p is None else p for p in parts]
                yield found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.int32)
            runs.clear()
            plan.clear()
            if len(self.known) > self.remember or len(self.ids) > 8 * self.remember:
                self._forget()

        for t in texts:
            parts: list = []
            for piece in self._split(t):
                if isinstance(piece, str):
                    if own and size + len(piece) > AT_ONCE:
                        cut()
                        size = 0
                    parts.append(None)
                    own.append(piece)
                    size += len(piece)
                else:
                    parts.append(np.array([piece], np.int32))
            plan.append(parts)
            done += len(t)
            if done > MERGE_ONCE:
                yield from flush()
                size = done = 0
        yield from flush()

    def _split(self, text: str) -> Iterator[str | int]:
        if not any(s in text for s in self.v.special):
            yield from _parts(text)
            return
        at = 0
        while at < len(text):
            near = min(((i, -len(s), s) for s in self.v.special if (i := text.find(s, at)) >= 0), default=None)
            if near is None:
                yield from _parts(text[at:])
                return
            yield from _parts(text[at : near[0]])
            yield self.v.special[near[2]]
            at = near[0] - near[1]


def _parts(text: str) -> Iterator[str]:
    """A long text in parts, cut before blanks between letters, where words always end."""
    at = 0
    while len(text) - at > AT_ONCE and (m := _CUT.search(text, at + AT_ONCE)):
        yield text[at : m.start()]
        at = m.start()
    if at < len(text):
        yield text[at:]


def decode(ids: np.ndarray, v: Vocabulary) -> str:
    """Special tokens are written out; bytes that are no UTF-8 become U+FFFD."""
    table = v.bytes
    return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


def _vocabulary(name: str) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name))


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and tokens (array of int) of every row."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(_vocabulary(vocabulary))
        for batch in it:
            ids = [x.astype(np.int32) for x in e.encode([t or "" for t in batch.column("text").to_pylist()])]
            cuts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat)], ["doc_id", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, tokens array<int>")


def decoded(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and text from doc_id and tokens; null tokens give a null text."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(vocabulary)
        for batch in it:
            texts = [None if x is None else decode(np.array(x, np.int64), v) for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "tokens").mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, so ids never leave the worker."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(vocabulary)
        e, decimal = Encoder(v), [str(i) for i in range(v.size)]
        for batch in it:
            n, of_ids, of_text = [], [], []
            for ids in e.encode([t or "" for t in batch.column("text").to_pylist()]):
                own = ids.tolist()
                n.append(len(own))
                of_ids.append(hashlib.sha256(",".join([decimal[i] for i in own]).encode()).hexdigest())
                of_text.append(hashlib.sha256(decode(ids, v).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
