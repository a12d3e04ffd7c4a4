"""WARC archives (operator 13): a writer of gzip members and a reader that splits archives at any byte.

Every record is a gzip member of its own. The reader deals byte ranges of the files out to tasks. A task looks for the
gzip magic in its range, takes each place as a candidate and decodes it: it is a record only if its data begin with a
WARC header, the block is as long as the header says, two line ends follow and the member's checksum holds. A task owns
the records that start in its range and reads beyond its end to finish the last one. A member may hold, uncompressed, a
whole archive whose records look real to the task that starts inside it; so each range also reports where its last
member ends, and records that start before such an end of an earlier range are dropped.

Payloads of ``LEAST`` bytes or more that are equal are stored once: the record of the smallest page_id is the response,
the others are revisits of it. Records are compressed, decoded and hashed piece by piece. Payload bytes are not shuffled
if the repeated digests are few enough to be sent to all tasks (counted first), else they meet in a join.

Files have names of their own for each attempt of a task, and only those that the finished job lists are read, so lost or
repeated tasks leave nothing in the result. The folder must be one that pyarrow opens (file, hdfs, s3, gs, abfs).

Defined results: null html is the empty payload; short payloads are all responses; rows of the smallest page_id are
responses, also if there are several; null ids count as the largest, and repeated payloads without any id are all
responses. Null urls are named after the page. Control characters and blanks of urls are percent-encoded. An empty table
gives no files and no rows; further columns are ignored, whatever their names. A file that does not hold the records that
were written is an error.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import checkpoint, scratch

LEAST = 100
#: Bytes of an archive at most, but for its last record, and of a range that is read as one.
FILE_BYTES, RANGE_BYTES = 1 << 30, 8 << 20
#: Repeated digests that are sent to all tasks at most (about 10 MB).
MAX_HINTED = 100_000
#: Tasks of a read at most.
MAX_TASKS = 20_000
#: Bytes that are read or decoded at once, and of a header at most.
PIECE, MAX_HEADER = 1 << 18, 1 << 20
MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "path string, n_bytes bigint, n_records bigint"
RECORDS = "path string, start bigint, offset bigint, stop bigint, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes bigint"
_NAMES = [x.split()[0] for x in RECORDS.split(", ")]


def opened(folder: str):
    """The file system of a folder or file, and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", identifier or "")
    return int(found[1]) if found else None


def uri(url: str | None, page_id: int | None) -> str:
    if not url:
        return record_id(page_id)[1:-1]
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


# Writing -----------------------------------------------------------------------------------------------------------------


def head(page_id: int | None, url: str | None, digest: str, n: int, refers_to: int | None) -> bytes:
    """The WARC header and the HTTP header of a record; a revisit's block has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    fields = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri(url, page_id)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (n if refers_to is None else 0)}"]
    return "\r\n".join(fields).encode() + END + http


def member(start: bytes, payload: bytes) -> Iterator[bytes]:
    """One gzip member: header, payload and the two line ends, in pieces."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    yield z.compress(start)
    for at in range(0, len(payload), PIECE):
        yield z.compress(payload[at : at + PIECE])
    yield z.compress(END) + z.flush()


def duplicates(pages: DataFrame) -> DataFrame:
    """payload_digest, first: digests of payloads of LEAST bytes or more that several rows have, and their smallest page_id."""
    own = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).filter(F.octet_length("html") >= LEAST)
    found = own.select("page_id", F.sha2("html", 256).alias("payload_digest")).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return found.filter("n > 1 AND first IS NOT NULL").select("payload_digest", "first")


def written(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes pages (page_id, url, html) as archives into ``folder``; path, n_bytes, n_records of each."""
    repeated = checkpoint(duplicates(pages))
    few = repeated.count() <= MAX_HINTED
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("payload_digest", F.sha2("html", 256))
    rows = keyed.join(F.broadcast(repeated) if few else repeated, "payload_digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    # A revisit's payload goes no further than this: only its length and digest are stored.
    rows = rows.select("page_id", "url", "payload_digest", F.octet_length("html").cast("long").alias("n"), F.when(refers.isNull(), F.col("html")).alias("html"), refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        out, path, n, size, done = None, "", 0, 0, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload_digest", "n", "html", "refers_to")]
            for page_id, url, digest, length, html, refers_to in zip(*columns, strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, n, size = f"{folder}/{name}", 0, 0
                    out = store.open_output_stream(posixpath.join(base, name), compression=None)  # or the name would choose one
                for piece in member(head(page_id, url, digest, length, refers_to), (html or "").encode()):
                    out.write(piece)
                    size += len(piece)
                n += 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((path, size, n))
        if out is not None:
            out.close()
            done.append((path, size, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["path", "n_bytes", "n_records"])

    store, base = opened(folder)
    store.create_dir(base, recursive=True)
    return checkpoint(rows.mapInArrow(run, FILES))


# Reading -----------------------------------------------------------------------------------------------------------------


@dataclass
class Record:
    """A decoded record; ``stop`` is the offset behind its member."""

    stop: int
    fields: dict[str, str]
    payload_digest: str
    payload_bytes: int
    payload: bytes | None


def _fields(raw: bytes) -> tuple[str, dict[str, str]]:
    """First line and fields (names in lower case) of a header."""
    first, *lines = raw.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _pieces(f, at: int, stops: list[int]) -> Iterator[bytes]:
    """The data of the gzip member at ``at``, decoded in pieces of PIECE bytes at most; its end goes to ``stops``. zlib.error if it is none."""
    z, place = zlib.decompressobj(31), at
    while True:
        f.seek(place)
        raw = f.read(PIECE)
        if not raw:
            raise zlib.error("the file ends inside the member")
        place += len(raw)
        while not z.eof:
            yield (data := z.decompress(raw, PIECE))
            raw = z.unconsumed_tail
            if not raw and len(data) < PIECE:
                break
        if z.eof:
            stops.append(place - len(z.unused_data))
            return


def decoded(f, at: int, keep: bool = False) -> Record | None:
    """The record whose member starts at ``at``; None if there is none. ``keep``: with its payload."""
    stops: list[int] = []
    pieces = _pieces(f, at, stops)
    held = b""

    def header() -> bytes | None:
        nonlocal held
        while (cut := held.find(END)) < 0:
            if len(held) > MAX_HEADER or (piece := next(pieces, None)) is None:
                return None
            held += piece
        raw, held = held[:cut], held[cut + len(END) :]
        return raw

    try:
        while len(held) < 7:
            if (piece := next(pieces, None)) is None:
                return None
            held += piece
        if not held.startswith(b"WARC/1.") or (raw := header()) is None:
            return None
        _, fields = _fields(raw)
        if not fields.get("content-length", "").isdecimal() or "warc-type" not in fields:
            return None
        left, http = int(fields["content-length"]), {}
        if fields.get("content-type", "").startswith("application/http") and left:
            if (raw := header()) is None:
                return None
            http, left = _fields(raw)[1], left - len(raw) - len(END)
        if left < 0:
            return None
        digest, n, kept, tail = hashlib.sha256(), 0, [], b""
        while True:
            part, held = held[: left - n], held[left - n :]
            digest.update(part)
            n += len(part)
            if keep:
                kept.append(part)
            tail += held
            if len(tail) > len(END) or (piece := next(pieces, None)) is None:
                break
            held = piece
    except zlib.error:
        return None
    if n != left or tail != END or not stops:
        return None
    size, sha = n, digest.hexdigest()
    named = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if fields["warc-type"] == "revisit":
        size, sha = int(http.get("content-length", "0")), named
    elif named and len(named) == 64 and named != sha:
        return None
    return Record(stops[0], fields, sha, size, b"".join(kept) if keep else None)


def candidate(f, start: int, end: int) -> int | None:
    """The first place from ``start`` and before ``end`` where the gzip magic stands."""
    while start < end:
        f.seek(start)
        raw = f.read(min(PIECE, end - start + len(MAGIC) - 1))
        if (at := raw.find(MAGIC)) >= 0:
            return start + at if start + at < end else None
        if len(raw) < len(MAGIC):
            return None
        start += len(raw) - len(MAGIC) + 1
    return None


def owned(f, start: int, end: int) -> Iterator[tuple[int, Record]]:
    """Offset and record of the members that start in the range."""
    while (at := candidate(f, start, end)) is not None:
        if (found := decoded(f, at)) is None:
            start = at + 1
        else:
            yield at, found
            start = found.stop


def ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, start, end of the ranges of files (path, n_bytes), evenly dealt out."""
    rows = files.filter("n_bytes > 0").select("path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    n = files.agg(F.sum(F.ceil(F.col("n_bytes") / range_bytes))).first()[0] or 1
    return rows.select("path", "start", F.least(F.col("start") + range_bytes, F.col("n_bytes")).alias("end")).repartition(int(min(n, MAX_TASKS)))


def indexed(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows of RECORDS for each record of files (path, n_bytes and, if known, n_records), without payloads.

    ``n_records`` is compared with the records found; a file that holds another number is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "end")], strict=True):
                store, place = opened(path)
                rows: list[tuple] = []
                with store.open_input_file(place) as f:
                    for at, r in owned(f, start, end):
                        x = r.fields
                        rows.append((path, start, at, r.stop, x["warc-type"], x.get("warc-record-id"), x.get("warc-target-uri"), x.get("warc-refers-to"), r.payload_digest, r.payload_bytes))
                        if len(rows) == 5000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    found = checkpoint(ranges(files, range_bytes).mapInArrow(run, RECORDS))
    # One row a range; a member that began in an earlier range hides what a later one found inside it.
    last = found.groupBy("path", "start").agg(F.max("stop").alias("_stop"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    hidden = last.select("path", "start", F.max("_stop").over(earlier).alias("_hidden")).filter("_hidden > start")
    out = found.join(hidden, ["path", "start"], "left").filter("_hidden IS NULL OR offset >= _hidden").drop("_hidden")
    if "n_records" in files.columns:
        counts = out.groupBy("path").agg(F.count("*").alias("n"))
        bad = files.join(counts, "path", "left").filter("n_records <> coalesce(n, 0)").select("path", "n_records", "n").take(5)
        if bad:
            raise ValueError(f"archives that do not hold what was written: {bad}")
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[kind.split()[1]]) for x, kind in zip(zip(*rows, strict=True), RECORDS.split(", "), strict=True)], _NAMES)


def payloads(index: DataFrame) -> DataFrame:
    """path, offset, payload (binary) of the records of an index; a revisit's is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(*[batch.column(c).to_pylist() for c in ("path", "offset")], strict=True):
                store, place = opened(path)
                with store.open_input_file(place) as f:
                    r = decoded(f, at, keep=True)
                if r is None:
                    raise ValueError(f"no record at {at} of {path}")
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([at], pa.int64()), pa.array([r.payload], pa.binary())], ["path", "offset", "payload"])

    return index.select("path", "offset").mapInArrow(run, "path string, offset bigint, payload binary")


def listed(spark, folder: str) -> DataFrame:
    """path, n_bytes of the archives in a folder; their bytes are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", F.col("length").alias("n_bytes"))


def archived(pages: DataFrame, folder: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Writes the pages' archives and reads them: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri."""
    files = written(pages, folder or scratch(pages.sparkSession, "warc"))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(F.col(c)) != "", page(F.col(c)).cast("long"))
    return indexed(files, range_bytes).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "target_uri")


SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
m AS (SELECT page_id, t, strlen(t) AS n, CASE WHEN strlen(t) >= {LEAST} THEN min(page_id) OVER (PARTITION BY t) END AS f FROM p),
r AS (SELECT *, f IS NOT NULL AND (page_id IS NULL OR page_id > f) AS again FROM m)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(t) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN f END AS refers_to FROM r"""
