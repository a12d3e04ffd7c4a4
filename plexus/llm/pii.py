"""Pseudonyms for personal data (operator 2).

Values are found by pattern and, where their format has a rule, validated (card check digits, IBAN remainders, real
dates, octets, social security ranges). Each is replaced by a keyed permutation of its own format: a Feistel network
over the whole numbers below the count of such values, walked on until the result is valid again. It is a bijection, so
equal values stay equal across documents and different values stay different, and nothing is stored or shuffled.

Numbers and dates keep their punctuation and the width of their fields, check digits are recomputed, mail keeps its last
two domain labels; keys and named secrets are permuted letter by letter class, letters of other scripts within
their neighbourhood, their punctuation stays. A named secret runs to its closing quote or, without quotes, to white space,
a quote or the line's end, less the punctuation that ends a clause. Where a candidate fails validation, its shorter runs that end at a
separator and the later kinds are tried, then what begins further on inside it; numbers that fail all are left alone.

Defined results: null texts stay null with no finds; empty texts likewise; texts without finds come back unchanged, byte
for byte; very long texts are scanned whole; repeated rows are replaced alike; of values that overlap the first counts, at one
place by the order of the kinds; an empty table gives no rows; all other columns pass through, whatever their names, but
for the two that ``counts`` adds.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import hmac
import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: For tests and demonstrations; real runs pass a secret of their own.
KEY = b"a key of your own goes here"
ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def permute(x: int, n: int, tweak: str, key: bytes) -> int:
    """A keyed permutation of 0..n-1: an alternating Feistel network over a * b >= n, repeated until it is below n."""
    if n < 2:
        return x
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    width = (a.bit_length() + 7) // 8 + 16
    while True:
        left, right = x % a, x // a
        for r in range(ROUNDS):
            source = right if r % 2 == 0 else left
            seed = hmac.new(key, f"{tweak}|{n}|{r}|{source}".encode(), hashlib.sha256).digest()
            f = int.from_bytes(hashlib.shake_256(seed).digest(width), "big")
            if r % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        x = left + a * right
        if x < n:
            return x


#: Letters are permuted within their class, other scripts' within their neighbourhood; any other character stays.
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")
_CLASSED = frozenset("".join(CLASSES))
HEX = "0123456789abcdef"
#: What secrets are named, in any case.
NAMES = "(?i:password|passwd|token|secret|api[_-]?key)"


#: Characters that are permuted as one number at most.
SEGMENT = 128
#: Code points of a neighbourhood.
NEIGHBOURS = 128


@functools.lru_cache(1 << 16)
def _alphabet(c: str) -> str:
    """The characters that may stand for ``c``: its class, or those of its category in its run of NEIGHBOURS code points."""
    if own := next((a for a in CLASSES if c in a), ""):
        return own
    kind, first = unicodedata.category(c), ord(c) // NEIGHBOURS * NEIGHBOURS
    if kind[0] not in "LN":
        return c
    return "".join(x for x in map(chr, range(first, first + NEIGHBOURS)) if unicodedata.category(x) == kind and x not in _CLASSED)


def by_class(s: str, tweak: str, key: bytes, alphabets: list[str] | None = None) -> str:
    """``s`` permuted within the alphabets of its characters.

    A longer value is permuted in segments, forwards and then backwards, each with the result of the one before it as a
    tweak. That is a permutation too, and every segment depends on all of the value.
    """
    own = alphabets or [_alphabet(c) for c in s]
    if len(s) <= SEGMENT:
        return _as_number(s, tweak, key, own)
    parts = [s[i : i + SEGMENT] for i in range(0, len(s), SEGMENT)]
    for way in (range(len(parts)), range(len(parts) - 1, -1, -1)):
        before = f"{tweak}/{way.step}"
        for i in way:
            parts[i] = _as_number(parts[i], f"{tweak}/{i}/{hashlib.sha256(before.encode()).hexdigest()}", key, own[i * SEGMENT : (i + 1) * SEGMENT])
            before = parts[i]
    return "".join(parts)


def _as_number(s: str, tweak: str, key: bytes, own: list[str]) -> str:
    """``s`` read as a number with a digit per character, permuted, and written again."""
    n, x = 1, 0
    for c, a in zip(s, own, strict=True):
        n *= len(a)
        x = x * len(a) + a.index(c)
    y = permute(x, n, tweak + "|" + ",".join(str(len(a)) for a in own), key)
    out = []
    for a in reversed(own):
        y, d = divmod(y, len(a))
        out.append(a[d])
    return "".join(reversed(out))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def refill(shape: str, symbols: str) -> str:
    """``shape`` with its letters and digits replaced, in order."""
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def card(m: re.Match, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if not luhn(digits) or len(set(digits)) == 1:
        return None
    body = by_class(digits[:-1], "card", key)
    return refill(m[0], body + next(c for c in "0123456789" if luhn(body + c)))


def phone(m: re.Match, key: bytes) -> str:
    kept = re.match(r"\+\d{1,3}(?=\D)", m[0])
    head = kept[0] if kept else ""
    digits = re.sub(r"\D", "", m[0][len(head) :])
    return head + refill(m[0][len(head) :], by_class(digits, "phone", key))


def ssn_valid(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def ssn(m: re.Match, key: bytes) -> str | None:
    d = m[0].replace("-", "")
    if not ssn_valid(d):
        return None
    while True:
        d = by_class(d, "ssn", key)
        if ssn_valid(d):
            return f"{d[:3]}-{d[3:5]}-{d[5:]}"


def ipv4(m: re.Match, key: bytes) -> str | None:
    parts = [int(p) for p in m[0].split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in m[0].split(".")):
        return None
    y = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ipv4", key)
    return ".".join(map(str, y.to_bytes(4, "big")))


def date(m: re.Match, key: bytes) -> str | None:
    a, sep, b, c = re.match(r"(\d+)([-/.])(\d+)[-/.](\d+)$", m[0]).groups()
    iso = len(a) == 4
    orders = [(a, b, c)] if iso else [(c, b, a), (c, a, b)]  # day first, else month first
    for i, (y, mo, d) in enumerate(orders):
        try:
            day = datetime.date(int(y), int(mo), int(d)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            continue
        # A date that can be read either way must stay one that is read the same way, and a field of one digit stays one.
        wide = len(mo), len(d)
        while True:
            day = FIRST_DAY + permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, f"date{i}{wide}", key)
            new = datetime.date.fromordinal(day)
            if (i == 0 or new.day > 12) and all(w == 2 or x < 10 for w, x in zip(wide, (new.month, new.day), strict=True)):
                break
        month, date_ = f"{new.month:0{wide[0]}}", f"{new.day:0{wide[1]}}"
        return sep.join((f"{new.year:04}", month, date_) if iso else (date_, month, f"{new.year:04}") if i == 0 else (month, date_, f"{new.year:04}"))
    return None


def iban_number(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4]))


def iban(m: re.Match, key: bytes) -> str | None:
    s = m[0].replace(" ", "")
    if not 15 <= len(s) <= 34 or iban_number(s) % 97 != 1:
        return None
    body = by_class(s[4:], "iban" + s[:2], key)
    return refill(m[0], f"{s[:2]}{98 - iban_number(s[:2] + '00' + body) % 97:02}{body}")


def mail(m: re.Match, key: bytes) -> str:
    local, _, domain = m[0].partition("@")
    labels = domain.split(".")
    own = ".".join(labels[:-2])
    return by_class(local, "mail", key) + "@" + (by_class(own, "domain", key) + "." if own else "") + ".".join(labels[-2:])


def secret(m: re.Match, key: bytes) -> str:
    head = m["name"] or ""
    value = next(v for v in (m["double"], m["single"], m["value"]) if v is not None)
    lower, upper = re.fullmatch(r"[0-9a-f]{12,}", value), re.fullmatch(r"[0-9A-F]{12,}", value)
    alphabets = [HEX if lower else HEX.upper()] * len(value) if lower or upper else None
    new = value
    while True:
        new = by_class(new, "secret" if head else "key", key, alphabets)
        # Digits alone count as lower-case, so an upper-case value must keep a letter.
        if lower or not upper or not new.isdigit():
            start = max(m.start(g) for g in ("double", "single", "value")) - m.start()
            return m[0][:start] + new + m[0][start + len(value) :]


def access_key(m: re.Match, key: bytes) -> str:
    return m[0][:4] + by_class(m[0][4:], "access", key)


#: Fixed patterns, by kind, tried in this order, with what replaces a match; None: it fails validation.
KINDS = {
    "mail": (r"(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)+", mail),
    "access_key": (r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", access_key),
    "secret": (rf"(?<!\w)(?P<name>{NAMES})[\"']?\s{{0,3}}[=:]\s{{0,3}}(?:\"(?P<double>[^\"\r\n]{{8,}})\"|'(?P<single>[^'\r\n]{{8,}})'|[\"']?(?P<value>[^\s\"']{{8,}})(?<![.,;:!?)\]}}>]))", secret),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", iban),
    "ipv4": (r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)", ipv4),
    "date": (r"(?<![\d./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?!\d|[-/]\d)", date),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ssn),
    "phone": (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])", phone),
    "card": (r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?!\d)", card),
}
_GROUPS = re.compile(r"\\(\d)")
_ALONE = {name: re.compile(pattern) for name, (pattern, _) in KINDS.items()}


def compiled() -> re.Pattern:
    """All kinds in one pattern, so each place of a text is replaced once at most."""
    parts, offset = [], 0
    for name, (pattern, _) in KINDS.items():
        shifted = _GROUPS.sub(lambda m, o=offset: f"\\{int(m[1]) + o + 1}", pattern)
        parts.append(f"(?P<{'k_' + name}>{shifted})")
        offset += 1 + re.compile(pattern).groups
    return re.compile("|".join(parts))


#: What every value of a kind holds, so that texts without any of it need no search; digits of all scripts.
HINTS = {"mail": "@", "access_key": "AKIA|ASIA", "secret": rf"{NAMES}[\"']?\s{{0,3}}[=:]"} | dict.fromkeys(("iban", "ipv4", "date", "ssn", "phone", "card"), r"\d")
_HINT = re.compile("|".join(dict.fromkeys(HINTS[kind] for kind in KINDS)))


def replaced(text: str, at: int, first: str, key: bytes) -> tuple[str, int, str] | None:
    """Kind, end and pseudonym of the first valid value at ``at``: kinds from ``first`` on, of each the longest run first."""
    kinds = list(KINDS)
    for kind in kinds[kinds.index(first) :]:
        m = _ALONE[kind].match(text, at)
        if not m:
            continue
        stops = [at + i for i, c in enumerate(m[0]) if c in " -"]
        for stop in (m.end(), *reversed(stops)):
            # The run ends before a separator, so what follows it needs no look.
            run = _ALONE[kind].fullmatch(text, at, stop) if stop < m.end() else m
            new = KINDS[kind][1](run, key) if run else None
            if new is not None:
                return kind, stop, new
    return None


def pseudonyms(text: str | None, key: bytes, pattern: re.Pattern) -> tuple[str | None, list[str]]:
    """The text with its values replaced, and the kinds of the values that were."""
    if not text or not _HINT.search(text):
        return text, []
    found: list[str] = []
    out, done, at = [], 0, 0
    while m := pattern.search(text, at):
        kind = m.lastgroup[2:] if m.lastgroup and m.lastgroup.startswith("k_") else next(k for k in KINDS if m[f"k_{k}"] is not None)
        hit = replaced(text, m.start(), kind, key)
        if hit is None:
            at = m.start() + 1
            continue
        kind, at, new = hit
        if new != text[m.start() : at]:
            found.append(kind)
        out += [text[done : m.start()], new]
        done = at
    return "".join([*out, text[done:]]), found


def pseudonymised(docs: DataFrame, key: bytes = KEY, counts: bool = True) -> DataFrame:
    """``docs`` with ``text`` replaced; with ``counts`` also n_values and kinds (distinct, in alphabetical order, joined
    by commas), which replace columns of those names."""
    keep = [c for c in docs.columns if not counts or c.lower() not in ("n_values", "kinds")]
    rows = docs.select(*keep)
    names = [*keep, *(["n_values", "kinds"] if counts else [])]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = compiled()
        for batch in it:
            at = keep.index("text")
            got = [pseudonyms(t, key, pattern) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in got], pa.string())
            if counts:
                columns += [pa.array([len(f) for _, f in got], pa.int64()), pa.array([",".join(sorted(set(f))) for _, f in got], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = StructType(list(rows.schema.fields))
    if counts:
        schema = schema.add("n_values", "long").add("kinds", "string")
    return rows.mapInArrow(run, schema)
