"""Word and shingle hashes of many texts at once in numpy."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the spans that begin there, end to end."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end]: sums of a mixed hash of each value and its place in the span.

    Value and place are mixed before they are summed, so no arithmetic relation between the letters of two spans, as
    in sums of powers, makes them alike.
    """
    size = end - start
    at = _places(start, size)
    place = at - np.repeat(start, size)
    mixed = mix64((place.astype(np.uint64) << np.uint64(21)) + values[at].astype(np.uint64) + np.uint64(1))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
    upto = np.cumsum(size)
    return mix64(sums[upto] - sums[upto - size] + size.astype(np.uint64))


def span_ids(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each span, alike for equal spans only, and where the first span of each number stands.

    Spans are sorted by hash and then compared with the first of their hash, value by value; those that differ from it
    are told apart by their values.
    """
    _, first, number = np.unique(span_hashes(values, start, end), return_index=True, return_inverse=True)
    size, like = end - start, first[number]
    differ = size != size[like]
    check = np.flatnonzero(~differ & (like != np.arange(len(start))))
    if check.size:
        away = values[_places(start[check], size[check])] != values[_places(start[like[check]], size[check])]
        if away.any():
            differ[check[np.repeat(np.arange(len(check)), size[check])[away]]] = True
    if differ.any():
        more: dict[bytes, int] = {}
        first = first.tolist()
        for i in np.flatnonzero(differ).tolist():
            own = values[start[i] : end[i]].tobytes()
            if own not in more:
                more[own] = len(first)
                first.append(i)
            number[i] = more[own]
        first = np.array(first)
    return number, first


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than ASCII white space."""
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def batches(texts: list, most: int = 1 << 20):
    """Runs of whole texts of at most ``most`` bytes each, unless one text alone is longer: (first index, byte strings)."""
    own, size, first = [], 0, 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "replace")
        if own and size + len(b) > most:
            yield first, own
            own, size, first = [], 0, i
        own.append(b)
        size += len(b) + 1
    if own:
        yield first, own


def hashed_words(own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and for each text where its words begin, with the total at the end."""
    data = np.frombuffer(b"\n".join(own) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    start, end = word_spans(data)
    return span_hashes(data, start, end), np.concatenate(([0], np.searchsorted(start, ends)))


def numbered_words(own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Like ``hashed_words``, but with numbers that only equal words share."""
    data = np.frombuffer(b"\n".join(own) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    start, end = word_spans(data)
    number, _ = span_ids(data, start, end)
    return number, np.concatenate(([0], np.searchsorted(start, ends)))


def window_ids(number: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of ``k`` numbers, alike for equal runs only."""
    own = number.astype(np.int64)
    for j in range(1, k):
        _, own = np.unique(own[: len(number) - j] * (len(number) + 1) + number[j:], return_inverse=True)
    return own


def windows(h: np.ndarray, bounds: np.ndarray, k: int, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words inside a text, the text of each and its first word.

    whole: a text of fewer words, but one at least, gives the hash of all its words.
    """
    counts = np.diff(bounds)
    acc = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        acc = mix64(acc * _BASE + h[j : len(h) - k + 1 + j] + np.uint64(j + 1)) if len(acc) else acc
    n = np.maximum(0, counts - k + 1)
    first = np.repeat(bounds[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    out, text = acc[first], np.repeat(np.arange(len(counts)), n)
    if whole and (short := np.flatnonzero((counts > 0) & (counts < k))).size:
        own = np.array([_fold(h[bounds[i] : bounds[i + 1]]) for i in short], np.uint64)
        out, text, first = np.concatenate((out, own)), np.concatenate((text, short)), np.concatenate((first, bounds[short]))
        order = np.argsort(text, kind="stable")
        out, text, first = out[order], text[order], first[order]
    return out, text, first


def _fold(h: np.ndarray) -> int:
    acc = np.array([len(h) + 0x5F3759DF], np.uint64)
    for x in h:
        acc = mix64(acc * _BASE + x)
    return int(acc[0])
