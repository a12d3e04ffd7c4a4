"""URL filters (operator 5), DataFrame operations only.

A small labelled URL table trains a logistic regression on hashed character n-grams of host and path. The features of
training and judged URLs come from the same DataFrame expression; the fit itself handles the labelled table only, whose
rows are bounded by MAX_LABELLED, and yields one weight per hash slot, which joins the judging expression as a constant.
Host and path rules come first; the longest that fits decides.

Defined results: a null url or one without ``://`` has an empty host and path, no rule, and the model's verdict on the
empty string; very long urls are judged by all their n-grams; a score equal to the threshold blocks; repeated rows are
judged alike; an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.llm.common import lower_ascii

#: Fixed values: (action, host suffix, path prefix).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
SLOTS = 4096
GRAMS = (3, 4, 5)
MAX_LABELLED = 1000
STEPS = 100
RATE = 10.0
DECAY = 1e-4

#: The labelled table is made from words of either label, invented names, paths of either label and paths of both. None of
#: the words is in the tables that the filter is tried on.
BAD_WORDS = ("slots", "xxx", "loans", "seo", "click", "cams", "dating", "bonus", "poker", "roulette", "jackpot", "replica", "forex", "lottery", "payday", "warez", "escort", "gambling", "pharmacy", "torrent")
GOOD_WORDS = ("library", "museum", "school", "news", "garden", "city", "weather", "forum", "recipes", "history", "science", "travel", "music", "health", "council", "theatre", "railway", "river", "harbour", "village")
SYLLABLES = ("lo", "ren", "ga", "mir", "on", "vel", "sha", "ku", "ber", "ing", "wo", "nes", "zan", "al", "du", "cor")
BAD_PATHS = ("/roulette/bonus/spin-now", "/replica/watches/order", "/cams/dating/live.html", "/lottery/prize/claim")
GOOD_PATHS = ("/articles/history/bridges", "/docs/reference/index.html", "/recipes/bread/rye", "/council/minutes/2020")
PATHS = ("/", "/en/204", "/de/77/", "/fr/310.html", "/es/5", "/en/8841/")
FIRST = ("", "www.", "m.", "blog.")
LAST = (".example.com", ".example.net", ".example.org")


def labelled() -> list[tuple[str, int]]:
    """100 hosts of each label, each with a path of its label and four of either: 1000 rows."""
    n = len(BAD_WORDS)
    bad = [f"{BAD_WORDS[i]}-{BAD_WORDS[(i + k) % n]}" for k in (1, 3, 7, 9, 13) for i in range(n)]
    good = [f"{GOOD_WORDS[i]}-{GOOD_WORDS[(i + k) % n]}" for k in (1, 7) for i in range(n)]
    m = len(SYLLABLES)
    good += ["".join(SYLLABLES[x % m] for x in (i, 3 * i + 1 + i // m, 7 * i + 2)[: 2 + i % 2]) for i in range(len(bad) - len(good))]
    rows = []
    for y, hosts, own in ((1, bad, BAD_PATHS), (0, good, GOOD_PATHS)):
        for i, h in enumerate(hosts):
            paths = [own[i % len(own)], *(PATHS[(i + j) % len(PATHS)] for j in range(4))]
            rows += [(f"https://{FIRST[(i + j) % len(FIRST)]}{h}{LAST[(i + j) % len(LAST)]}{p}", y) for j, p in enumerate(paths)]
    return rows


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def slots(host: Column, path: Column) -> Column:
    """Hash slots of the n-grams of host and path, which have spaces of their own."""

    def of_size(tag: str, s: Column, n: int) -> Column:
        # The lambda has one parameter only: a second one, though it had a default, would be given the element's index.
        at = F.sequence(F.lit(1), F.greatest(F.length(s) - (n - 1), F.lit(1)))
        hashed = F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(tag), s.substr(i, F.lit(n))), F.lit(SLOTS)).cast("int"))
        return F.when(F.length(s) >= n, hashed).otherwise(F.array().cast("array<int>"))

    def grams(tag: str, s: Column) -> list[Column]:
        s = F.concat(F.lit("\x02"), s, F.lit("\x03"))
        return [of_size(tag, s, n) for n in GRAMS]

    return F.concat(*grams("h", host), *grams("p", path))


def fit(rows: list[tuple[list[int], int]], steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> list[float]:
    """Full-batch gradient descent on mean-scaled counts; the bias comes last. ``rows`` is the small labelled table."""
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"the labelled table is bounded by {MAX_LABELLED} rows")
    w, b = [0.0] * SLOTS, 0.0
    scaled = []
    for idx, y in rows:
        counts: dict[int, int] = {}
        for i in idx:
            counts[i] = counts.get(i, 0) + 1
        n = math.sqrt(max(1, len(idx)))
        scaled.append(([(i, c / n) for i, c in counts.items()], y))
    total = {y: sum(1 for r in rows if r[1] == y) or 1 for y in (0, 1)}
    for _ in range(steps):
        grad, gb = dict[int, float](), 0.0
        for xs, y in scaled:
            z = b + sum(w[i] * x for i, x in xs)
            g = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y) / (2 * total[y])
            gb += g
            for i, x in xs:
                grad[i] = grad.get(i, 0.0) + g * x
        b -= rate * 0.1 * gb
        for i, g in grad.items():
            w[i] -= rate * (g + decay * w[i])
    return [*w, b]


def train(spark: SparkSession, table: list[tuple[str, int]] | None = None) -> list[float]:
    urls = spark.createDataFrame(labelled() if table is None else table, "url string, label int")
    rows = urls.select(slots(host_of(F.col("url")), path_of(F.col("url"))).alias("s"), "label").orderBy("url").limit(MAX_LABELLED + 1).collect()
    return fit([(r["s"], r["label"]) for r in rows])


def judge(pages: DataFrame, weights: list[float], threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability of block)."""
    url = F.col("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    rule = action = None
    for act, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    constant = F.split(F.lit(" ".join(repr(x) for x in weights[:-1])), " ").cast("array<double>")
    found = parts.withColumn("_s", slots(host, path)).withColumn("_w", F.aggregate("_s", F.lit(0.0), lambda a, i: a + F.get(constant, i)))
    z = F.lit(weights[-1]) + F.col("_w") / F.sqrt(F.greatest(F.size("_s"), F.lit(1)))
    scored = found.select("page_id", "host", "path", rule.alias("rule"), action.alias("_action"), (1 / (1 + F.exp(-z))).alias("score"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_action", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
