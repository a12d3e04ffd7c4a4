import random

import pytest

SMALL = "/root/testdata/sf0.001"


def corpus():
    """Small documents with the awkward cases: nulls, blanks, copies, near copies, one long text, repeated rows."""
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdeghilmnorstuäéñ", k=rng.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    base = text(120)
    words = base.split(" ")
    rows = [(i, text(rng.randint(1, 200)), rng.choice(["a", "b", "c", None]), "en") for i in range(40)]
    rows += [(50 + i, base, "a", "en") for i in range(4)]
    for i in range(12):
        own = list(words)
        for _ in range(1 + i // 2):
            own[rng.randrange(len(own))] = rng.choice(vocab)
        rows.append((60 + i, " ".join(own), "a", "de"))
    rows += [(80, None, "a", None), (81, "", "b", "fr"), (82, " \t\n ", None, "fr"), (83, "one two three", "c", "en"), (84, "One TWO three", "c", "en"), (85, text(9000), "a", "en"), (85, text(50), "a", "en"), (86, "a\x0bb\x0cc\rd e f g", "b", "es"), (87, "\u00a0x\u2003y <|endoftext|> z", "b", "es"), (None, text(30), "b", "en"), (None, None, None, None)]
    rows.append(rows[3])
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string")


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = ["size", "target", "taken", "score", "n_tokens", "cls", "_row", "block", "key", "kinds", "n_values", "label", "digest", "_keep", "letter", "held_out", "sketch", "n_words", "failed", "kept", "check", "is_shingle", "_quality_score", "n_bytes", "comp", "n"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])
