"""Operators 11 to 13 against plain versions."""

import hashlib
import io
import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
from plexus.llm import align, centroids, warc

VECTORS = "vec_id long, embedding array<double>, label int, cluster string, distance string"


# 11 ----------------------------------------------------------------------------------------------------------------------


def plain_clusters(vectors, k, rounds, d):
    kept = [(i, [math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v]) for i, v in vectors if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    order = sorted((iv for iv in kept), key=lambda iv: (iv[0] is None, hashlib.sha256(f"2:{iv[0]}".encode()).hexdigest(), iv[1]))
    c = [v for _, v in order[:k]]
    assign = lambda: [min((far(v, x), j) for j, x in enumerate(c)) for _, v in kept]
    for _ in range(rounds):
        own = defaultdict(list)
        for (_, v), (_, j) in zip(kept, assign(), strict=True):
            own[j].append(v)
        c = [[sum(col) // len(own[j]) for col in zip(*own[j], strict=True)] if j in own else x for j, x in enumerate(c)]
    got = assign()
    by = defaultdict(int)
    for d_, j in got:
        by[j] += d_
    top = lambda x: min(x, centroids.LARGEST)
    each = defaultdict(int)
    for d_, j in got:
        each[j] += top(d_)
    total = sum(each.values())
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return Counter((i, j, top(d_), top(each[j]), top(total), sha[j]) for (i, _), (d_, j) in zip(kept, got, strict=True))


def clustered(spark, rows, k, rounds, d):
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VECTORS).repartition(3)
    return Counter(tuple(r) for r in centroids.clustered(df, k, rounds, dimensions=d).collect())


def test_clusters_equal_plain_rounds_with_odd_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [rows[3], rows[3], (None, rows[5][1])]
    rows += [(300, None), (301, []), (302, [0.0] * 7), (303, [0.0] * 7 + [None]), (304, [0.0] * 7 + [math.nan]), (305, [0.0] * 7 + [math.inf]), (306, [-0.0] * 8)]
    assert clustered(spark, rows, 6, 5, 8) == plain_clusters(rows, 6, 5, 8)


def test_clusters_of_ties_take_the_lowest_number(spark):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate((x, y) for x in range(-3, 4) for y in range(-3, 4))]
    assert clustered(spark, rows, 10, 3, 2) == plain_clusters(rows, 10, 3, 2)


@pytest.mark.parametrize("size", [1e4, 2.0**17.5, 1e9, 1e30, 1e307])
def test_clusters_of_huge_components(spark, size):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.1, 1.0, size]) * rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    assert clustered(spark, rows, 5, 3, 4) == plain_clusters(rows, 5, 3, 4)


def test_clusters_with_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    assert clustered(spark, rows, 5, 2, 2) == plain_clusters(rows, 5, 2, 2)
    assert clustered(spark, [], 5, 2, 2) == Counter()
    assert clustered(spark, [(1, None)], 5, 2, 2) == Counter()


def test_shortlist_never_loses_the_nearest():
    rng = np.random.default_rng(3)
    for size in (3, 300, 1 << 20, centroids.SMALL):
        c = rng.integers(-size, size, (30, 64))
        c[7] = c[3]
        v = np.concatenate([rng.integers(-size, size, (200, 64)), c, c + rng.integers(-1, 2, c.shape)])
        v = np.clip(v, -centroids.SMALL, centroids.SMALL)
        exact = ((v[:, None, :] - c[None]) ** 2).sum(axis=2)
        near = centroids.Nearest(c.tolist())
        open_ = near.shortlist(v)
        assert open_[np.arange(len(v)), exact.argmin(axis=1)].all()
        if size <= 300:
            assert open_.sum() < 3 * len(v)  # few are left
        got, d = near.small(v)
        assert (got == exact.argmin(axis=1)).all() and (d == exact.min(axis=1)).all()


# 12 ----------------------------------------------------------------------------------------------------------------------


def plain_alignment(rows):
    import public_tokenizers as p
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(p.path(align.A))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=p.path(align.B))
    letters = align.byte_symbols()
    special = {"<|endoftext|>"}
    docs = []
    for doc_id, text in rows:
        a, b, ends_a, ends_b = [], [], [], []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            of_a = [t.id_to_token(i).encode() if t.id_to_token(i) in special else bytes(letters[x] for x in t.id_to_token(i)) for i in a]
            of_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(of_a) != (" " + text).encode() or b"".join(of_b) != (" " + text).encode():
                a, b, of_a, of_b = [], [], [], []
            ends_a, ends_b = np.cumsum([len(x) for x in of_a]).tolist(), np.cumsum([len(x) for x in of_b]).tolist()
        linked = []
        i = j = 0
        while i < len(a) and j < len(b):
            linked.append((i, j))
            x, y = ends_a[i], ends_b[j]
            i, j = i + (x <= y), j + (y <= x)
        groups, start_a, start_b = [], 0, 0
        for cut in sorted({*ends_a} & {*ends_b}):
            ia, ib = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(",".join(map(str, a[start_a:ia])) + "|" + ",".join(map(str, b[start_b:ib])))
            start_a, start_b = ia, ib
        docs.append((doc_id, a, b, groups, [(a[x], b[y]) for x, y in linked]))
    counts = Counter(p for d in docs for p in {*d[4]})
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    sha = lambda g: hashlib.sha256(";".join(g).encode()).hexdigest() if g else ""
    return Counter((i, len(a), len(b), len(g), len(p), sum(counts[x] == most[x[0]] for x in p), sum(counts[x] for x in p), sha(g)) for i, a, b, g, p in docs)


AWKWARD = ["▁x", "a▁b", "<s>x</s> <0x41> <unk>", "<|endoftext|>", "<|endoftext|> <|endoftext|>x", " ", "\n\n\t", "x" * 3000, "é́ ﬁ \U0001f600\U0001f468‍\U0001f469 中文", "\x00\x01\x7f", "a" + " " * 5000 + "b"]


def test_alignment_equals_plain_version(spark, rows):
    own = [(r[0], r[1]) for r in rows] + [(1000 + i, t) for i, t in enumerate(AWKWARD)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in own], "doc_id long, text string, block string, codes string").repartition(3)
    for block_bytes in (align.BLOCK_BYTES, 700):
        assert Counter(tuple(r) for r in align.aligned(df, block_bytes=block_bytes).collect()) == plain_alignment(own)


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align.aligned(none).collect() == []
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, align.aligned(empty).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_parts_of_long_texts_give_the_same_pieces(monkeypatch):
    import public_tokenizers as p
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=p.path(align.B))
    rng = random.Random(4)
    monkeypatch.setattr(align, "PART", 50)
    encode, _ = align.pieces(p.path(align.B))
    for _ in range(200):
        t = "".join(rng.choice(["the ", "ing", " ", "  ", "\n", "é", "9 ", "Zx ", ". "]) for _ in range(rng.randint(1, 400)))
        assert encode(t) == sp.encode(t)


def test_union_find_on_any_graph():
    rng = random.Random(6)
    for _ in range(100):
        n = rng.randint(1, 60)
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 70))]
        least = list(range(n))
        while True:
            now = list(least)
            for a, b in edges:
                now[a] = now[b] = min(now[a], now[b])
            if now == least:
                break
            least = now
        assert align.roots(n, np.array([a for a, _ in edges], int), np.array([b for _, b in edges], int)).tolist() == least


# 13 ----------------------------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, first string, n string, payload_digest string"


def page_rows():
    rng = random.Random(7)
    text = lambda n: "".join(rng.choices("<>abc é\n", k=n))
    big, short = text(5000), text(60)
    rows = [(i, f"http://h/{i}", text(rng.randint(0, 900))) for i in range(80)]
    rows += [(100 + i, "http://copy", big) for i in range(25)] + [(130 + i, None, short) for i in range(5)]
    rows += [(140, "http://a b\r\nX: yü", None), (141, "", ""), (None, "http://n", big), (None, None, text(300)), (-5, "u", "é" * 50), (6, "u", "é" * 50), (-5, "u", "é" * 50), (150, "long", text(600_000))]
    same = text(200)
    return [*rows, (None, "a", same), (None, "b", same)]


def plain_pages(rows):
    least = defaultdict(list)
    for i, _, h in rows:
        if len((h or "").encode()) >= warc.LEAST and i is not None:
            least[h].append(i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        f = min(least[h]) if least.get(h) else None
        again = f is not None and (i is None or i > f)
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", f if again else None))
    return Counter(out)


@pytest.mark.parametrize("range_bytes", [3000, warc.RANGE_BYTES])
def test_archives_give_back_the_pages(spark, range_bytes):
    rows = page_rows()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES).repartition(2)
    got = warc.archived(df, range_bytes=range_bytes)
    assert Counter(tuple(r) for r in got.drop("target_uri").collect()) == plain_pages(rows)


def test_archives_of_repeated_pages_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(warc, "MAX_HINTED", 0)
    rows = page_rows()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)
    assert Counter(tuple(r) for r in warc.archived(df).drop("target_uri").collect()) == plain_pages(rows)


def test_archives_are_gzip_and_payloads_come_back(spark, tmp_path):
    rows = page_rows()
    folder = f"file://{tmp_path}/a"
    files = warc.written(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES).repartition(2), folder, file_bytes=20_000)
    assert files.count() > 2
    import gzip

    for path in (tmp_path / "a").iterdir():
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: ")
    found = warc.indexed(warc.listed(spark, folder), 5000)
    back = found.join(warc.payloads(found), ["path", "offset"]).filter("record_type = 'response'").select("payload", "payload_digest").collect()
    assert Counter(r["payload_digest"] for r in back) == Counter({k[2]: n for k, n in _responses(rows).items()})
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in back)


def _responses(rows):
    return Counter({(None, None, d): n for d, n in Counter(k[2] for k in plain_pages(rows).elements() if k[3] == "response").items()})


def test_records_inside_a_stored_archive_are_not_records(spark, tmp_path):
    """An outer member without compression holds whole inner members; tasks that start inside it meet real headers."""
    one = lambda i, body: warc.head(i, "u", hashlib.sha256(body).hexdigest(), len(body), None) + body + warc.END

    def gz(raw, level):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        return z.compress(raw) + z.flush()

    inner = b"".join(gz(one(100 + i, b"inner %d" % i * 20), 6) for i in range(40))
    raw = gz(one(1, b"before"), 6) + gz(one(2, inner), 0) + gz(one(3, b"after \x1f\x8b\x08 no member"), 0) + gz(one(4, b"end"), 6)
    (tmp_path / "x.warc.gz").write_bytes(raw)
    files = warc.listed(spark, f"file://{tmp_path}")
    for size in (150, 1 << 20):
        assert sorted(r["record_id"] for r in warc.indexed(files, size).collect()) == [f"<urn:page:{i}>" for i in range(1, 5)]


def test_a_member_belongs_to_the_range_in_which_it_starts():
    raw = b"".join(b"".join(warc.member(warc.head(i, "u", hashlib.sha256(b"x" * i).hexdigest(), i, None), b"x" * i)) for i in range(1, 40))
    starts = [at for at, _ in warc.owned(io.BytesIO(raw), 0, len(raw))]
    assert len(starts) == 39
    for step in (1, 7, 100):
        found = [at for s, e in pairwise([*range(0, len(raw), step), len(raw)]) for at, _ in warc.owned(io.BytesIO(raw), s, e)] if step > 1 else [at for at in range(0, 500) for at, _ in warc.owned(io.BytesIO(raw), at, at + 1)]
        assert found == (starts if step > 1 else [x for x in starts if x < 500])


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    files = warc.written(spark.createDataFrame([(i, "u", "x" * 50) for i in range(5)], "page_id long, url string, html string").coalesce(1), folder)
    path = next((tmp_path / "a").glob("*.warc.gz"))
    raw = bytearray(path.read_bytes())
    raw[-30] ^= 255
    path.write_bytes(raw)
    (tmp_path / "a" / f".{path.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="do not hold"):
        warc.indexed(files)


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
