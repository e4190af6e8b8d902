"""WARC archives of pages: writing them and a salvage reader.

Writing: one gzip member per record. The pages of equal payloads (at least
``SHORTEST_REVISIT`` bytes) share one response, that of the smallest ``page_id``; the
others are revisit records that name it. Records are gathered into archives of about
``archive_bytes``, each one row, and written as one file by Spark's text writer, so
any file system that Spark writes will do. A gzip member ends in the upper byte of
its length, which is zero below 16 MB; the writer's line separator is that zero byte.
A larger record is followed by an empty member, which ends in one too.

Reading: every archive is read as one row, so a task holds one archive at a time. The
reader checks each member (gzip's own checksum) or, in plain archives, each record
from its version line: header, block length, block digest. After a failed check it
searches on for the next gzip signature or version line that passes them, goes on
from there, and lists the bytes in between as a gap with its reason.

Defined cases: a null html is an empty payload; a null ``page_id`` gives a record
without the page header, which is never named by a revisit unless all its equals lack
it; rows that repeat the smallest id of equal payloads are all responses; an empty
table gives no archive and no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cartpulse.sources import scratch

SHORTEST_REVISIT = 100
ARCHIVE_BYTES = 8 << 20
_CHUNK = 1 << 16
_VERSION = b"WARC/1.1"
_SIGNATURE = b"\x1f\x8b\x08"
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_LINE = re.compile(rb"WARC/1\.[01]\r\n")
# a header ends before the next record's version line, however long it is
_HEADER_END = re.compile(rb"\r\n\r\n|\nWARC/1\.[01]\r\n")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_EMPTY_MEMBER = zlib.compress(b"", 9, 31)
RECORD = (
    "archive string, at bigint, bytes bigint, page_id bigint, payload_bytes bigint,"
    " payload_digest string, record_type string, refers_to bigint, url string, payload binary"
)
GAP = "archive string, at bigint, bytes bigint, reason string"


def _struct(ddl: str) -> str:
    return f"struct<{', '.join(field.replace(' ', ': ') for field in ddl.split(', '))}>"


_FOUND = f"record {_struct(RECORD)}, gap {_struct(GAP)}"


# ------------------------------------------------------------------ writing


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """A whole WARC record, uncompressed."""
    block = b"" if refers_to is not None else _HTTP % len(payload) + payload
    kind = "response" if refers_to is None else "revisit"
    header = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Target-URI": re.sub(r"[\r\n]", "", url or ""),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Payload-Length": len(payload),
    }
    if page_id is not None:
        header["Page-ID"] = page_id
    if refers_to is not None:
        header["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        header["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    header["Content-Length"] = len(block)
    lines = "".join(f"{name}: {value}\r\n" for name, value in header.items())
    return b"%s\r\n%s\r\n%s\r\n\r\n" % (_VERSION, lines.encode(), block)


def member(whole: bytes) -> bytes:
    packed = zlib.compress(whole, 6, 31)
    return packed if not packed[-1] else packed + _EMPTY_MEMBER


def _archives(archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for rows in batches:
            columns = (rows.column(n) for n in ("page_id", "url", "html", "digest", "refers_to"))
            for page_id, url, html, digest, refers_to in zip(*columns, strict=True):
                payload = (html.as_py() or "").encode()
                whole = record(
                    page_id.as_py(), url.as_py(), payload, digest.as_py(), refers_to.as_py()
                )
                held.append(member(whole))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield _archive(held)
                    held, size = [], 0
        if held:
            yield _archive(held)

    return run


def _archive(members: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([b"".join(members)[:-1]], pa.binary())], ["value"])


def with_originals(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to), ``refers_to`` for revisits only."""
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"),
    )
    long_enough = F.octet_length("html") >= SHORTEST_REVISIT
    first = (
        source.filter(long_enough)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"))
        .withColumnRenamed("digest", "of_digest")
    )
    same = (source["digest"] == first["of_digest"]) & long_enough
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return source.join(first, same, "left").select(
        "page_id", "url", "html", "digest", other.alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives, one file each."""
    rows = with_originals(pages).mapInArrow(_archives(archive_bytes), "value binary")
    (
        rows.select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


# ------------------------------------------------------------------ reading


@dataclass
class _Member:
    end: int
    data: bytes
    problem: str = ""


def _inflated(data: memoryview, at: int) -> _Member:
    """The gzip member at ``at``, or what is wrong with it."""
    inflater, parts, end = zlib.decompressobj(31), [], at
    try:
        while not inflater.eof:
            piece = data[end : end + _CHUNK]
            if not piece:
                return _Member(end, b"", "member is cut short")
            parts.append(inflater.decompress(piece))
            end += len(piece)
    except zlib.error as error:
        return _Member(end, b"", f"member is damaged: {str(error)[:60]}")
    return _Member(end - len(inflater.unused_data), b"".join(parts))


def parse_record(data: bytes, at: int = 0) -> tuple[int, dict[str, str], bytes, str]:
    """(end, header, block, problem) of the record at ``at``."""
    if not data.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n"), at):
        return at, {}, b"", "no version line"
    stop = _HEADER_END.search(data, at)
    if not stop or stop[0] != b"\r\n\r\n":
        return at, {}, b"", "header has no end"
    end = stop.start()
    header = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        header[name.decode("latin-1").strip().lower()] = value.decode(errors="replace").strip()
    length = header.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return at, header, b"", "no block length"
    begin, close = end + 4, end + 4 + int(length)
    if data[close : close + 4] != b"\r\n\r\n":
        return at, header, b"", "block length is wrong"
    block = bytes(data[begin:close])
    digest = header.get("warc-block-digest", "")
    if digest.startswith("sha256:") and digest[7:] != hashlib.sha256(block).hexdigest():
        return at, header, b"", "block digest differs"
    return close + 4, header, block, ""


def _records(data: bytes) -> list[tuple[dict[str, str], bytes] | str]:
    """(header, block) of every sound record of an inflated member, a reason for what is between."""
    found, at, reason = [], 0, ""
    while at < len(data):
        end, header, block, problem = parse_record(data, at)
        if problem:
            reason = reason or problem
            following = _LINE.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if reason:
            found.append(reason)
        found.append((header, block))
        at, reason = end, ""
    return [*found, reason] if reason else found


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | str, bytes]]:
    """(at, bytes, header, block) of every sound record, (at, bytes, reason, b"") of every gap.

    What stands in one member has the member's place; its bytes count with the first.
    """
    at, gap_at, reason = 0, 0, ""
    view = memoryview(data)
    while at < len(data):
        problem, end, found = "neither member nor version line", at, []
        if data.startswith(_SIGNATURE, at):
            inflated = _inflated(view, at)
            end, problem = inflated.end, inflated.problem
            if not problem and inflated.data:
                found = _records(inflated.data)
                if all(isinstance(what, str) for what in found):
                    problem = found[0]
        elif data.startswith(b"WARC/", at):
            end, header, block, problem = parse_record(data, at)
            found = [(header, block)]
        if problem:
            reason = reason or problem
            following = _NEXT.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if reason:
            yield gap_at, at - gap_at, reason, b""
        size = end - at
        for what in found:
            yield (at, size, what, b"") if isinstance(what, str) else (at, size, *what)
            size = 0
        at = gap_at = end
        reason = ""
    if reason:
        yield gap_at, len(data) - gap_at, reason, b""


def _page(text: str | None) -> int | None:
    found = re.search(r"-?\d+", text or "")
    return int(found[0]) if found else None


def _record_row(archive: str, at: int, size: int, header: dict[str, str], block: bytes) -> dict:
    kind = header.get("warc-type", "")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    named = header.get("warc-payload-digest", "").removeprefix("sha256:")
    stated = _page(header.get("payload-length"))
    return {
        "archive": archive,
        "at": at,
        "bytes": size,
        "page_id": _page(header.get("page-id")),
        "payload_bytes": stated if payload is None else len(payload),
        "payload_digest": named if payload is None else hashlib.sha256(payload).hexdigest(),
        "record_type": kind,
        "refers_to": _page(header.get("warc-refers-to")) if kind == "revisit" else None,
        "url": header.get("warc-target-uri"),
        "payload": payload,
    }


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """(record, gap) of every archive in a folder; one of the two is null.

    Counts and digests of responses are taken from their payload again, those of
    revisits from their header. ``with_payload=False`` leaves the payload null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for path, content in zip(
                rows.column("path").to_pylist(), rows.column("content"), strict=True
            ):
                found = []
                for at, size, what, block in salvage(content.as_py()):
                    if isinstance(what, str):
                        gap = {"archive": path, "at": at, "bytes": size, "reason": what}
                        found.append({"record": None, "gap": gap})
                    else:
                        row = _record_row(path, at, size, what, block)
                        if not with_payload:
                            row["payload"] = None
                        found.append({"record": row, "gap": None})
                    if len(found) == 1024:
                        yield pa.RecordBatch.from_pylist(found, kind)
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, kind)

    kind = to_arrow_schema(StructType.fromDDL(_FOUND))
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(run, _FOUND)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives to the shared folder and read their records back."""
    spark = pages.sparkSession
    folder = scratch.new_folder(spark, "warc")
    write_archives(pages, folder)
    found = read_archives(spark, folder, with_payload=False)
    return found.filter(F.col("record").isNotNull()).select(
        *[
            F.col(f"record.{name}").alias(name)
            for name in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        ]
    )


WARC_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS digest
  FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN payload_bytes >= {SHORTEST_REVISIT} AND page_id <> first THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {SHORTEST_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM q
"""
