"""WARC archives: one gzip member per record, written by Spark, read in sequence.

Writing. Pages with equal payloads of at least ``min_bytes`` bytes form a group;
the smallest page id is stored as a ``response`` record and the others as
``revisit`` records that refer to it. Digests merge per task before the
shuffle, and the join of pages with their group's first page is split by
adaptive execution when one payload fills a third of the table. Each task
builds its records and Spark's own text writer stores them, so a lost executor
leaves no half-written archive and any file system that Spark knows will do.
The writer ends every row with a line separator: it is set to the NUL byte,
which is also the last byte of a gzip member (the high byte of its length) for
records below 16 MiB and is taken off before; above, the NUL stays behind the
member as the padding that gzip allows.

Reading. Archives arrive as binary files. A member is inflated in small pieces,
its header is framed by the blank line, its block by ``Content-Length``, and
digests are checked as the bytes pass; no payload is held unless asked for.

Defined results: a null payload is empty; null page ids are written as such and
never refer to or serve as a first page; repeated rows with the first page's id
are all responses; control characters in a URL are percent-encoded; an empty
table gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

MIN_REVISIT_BYTES = 100
PIECE = 1 << 16
CRLF = b"\r\n"
# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-page:"

RECORD_SCHEMA = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, digest_ok boolean, payload binary"
)
RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("digest_ok", pa.bool_()),
        ("payload", pa.binary()),
    ]
)


class WarcError(ValueError):
    """An archive that does not follow the format or fails a digest."""


def with_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``; ``refers_to`` is set for revisits."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    firsts = (
        rows.filter((F.length("payload") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record, not yet compressed."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    )
    block = http if refers_to is not None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url or "")
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{RECORD_URN}{refers_to}>")]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}".encode() + CRLF for k, v in head)
    return VERSION + CRLF + lines + CRLF + block + CRLF + CRLF


def gzip_member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to archives in ``path``.

    Every output partition is one archive.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                page, url, payload, digest, refers = (c[row].as_py() for c in batch.columns)
                member = gzip_member(record_bytes(page, url, payload, digest, refers, date))
                body = member[:-1] if member[-1] == 0 else member
                yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["value"])

    records = with_roles(pages, min_bytes).mapInArrow(build, "value binary")
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def members(data: bytes) -> Iterator[Iterator[bytes]]:
    """For each gzip member of ``data`` an iterator over its inflated pieces."""
    view, at = memoryview(data), 0
    while at < len(view):
        if view[at] == 0:  # padding between members
            at += 1
            continue
        inflate = zlib.decompressobj(31)
        state = {"at": at}

        def pieces(inflate=inflate, state=state) -> Iterator[bytes]:
            while not inflate.eof:
                fed = bytes(view[state["at"] : state["at"] + PIECE])
                if not fed:
                    raise WarcError("the archive ends inside a member")
                out = inflate.decompress(fed)
                state["at"] += len(fed) - len(inflate.unused_data)
                if out:
                    yield out

        run = pieces()
        yield run
        for _ in run:  # what the caller left unread
            pass
        at = state["at"]


class _Stream:
    """Exact reads over pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def line(self) -> bytes:
        while CRLF not in self.held:
            more = next(self.pieces, None)
            if more is None:
                raise WarcError("a header line does not end")
            self.held += more
        out, _, self.held = self.held.partition(CRLF)
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held:
                self.held = next(self.pieces, None) or b""
                if not self.held:
                    raise WarcError("a block is shorter than its Content-Length")
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out

    def rest(self) -> bytes:
        return self.held + b"".join(self.pieces)


def _fields(stream: _Stream) -> dict[str, str]:
    found = {}
    while line := stream.line():
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(RECORD_URN)
    return int(number) if number else None


def read_record(pieces: Iterator[bytes], with_payload: bool = False) -> dict:
    """One record from the inflated pieces of its member, digests checked."""
    stream = _Stream(pieces)
    if stream.line() != VERSION:
        raise WarcError("not a WARC record")
    head = _fields(stream)
    length = int(head["content-length"])
    block, payload, kept, http, size = hashlib.sha256(), hashlib.sha256(), [], b"", None
    for piece in stream.take(length):
        block.update(piece)
        if size is None:
            http += piece
            if b"\r\n\r\n" not in http:
                continue
            lines, _, piece = http.partition(b"\r\n\r\n")
            size = int(re.search(rb"(?i)content-length: *(\d+)", lines)[1])
        payload.update(piece)
        if with_payload:
            kept.append(piece)
    if stream.rest() != CRLF + CRLF:
        raise WarcError("a record does not end with two line breaks")
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    ok = head["warc-block-digest"] == f"sha256:{block.hexdigest()}"
    if head["warc-type"] == "response":
        ok = ok and digest == payload.hexdigest()
    return {
        "page_id": _page(head["warc-record-id"]),
        "url": head["warc-target-uri"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": head["warc-type"],
        "refers_to": _page(head.get("warc-refers-to")),
        "digest_ok": ok,
        "payload": b"".join(kept) if with_payload and head["warc-type"] == "response" else None,
    }


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """All records of the archives in ``path``; a broken archive stops the job."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                found: list[dict] = []
                for pieces in members(content.as_py()):
                    found.append(read_record(pieces, with_payload))
                    if with_payload or len(found) == 1024:
                        yield pa.RecordBatch.from_pylist(found, schema=RECORD_ARROW)
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=RECORD_ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, RECORD_SCHEMA)
