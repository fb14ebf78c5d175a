"""WARC archives: written through Spark's committed file output, read back sequentially.

Writing.  Every record is one gzip member.  Of records with equal payloads
(equal SHA-256) of at least `min_bytes`, the one of the smallest id is a
`response`, the others are `revisit` records that refer to it and carry no
payload.  A task appends members to an archive until it has ARCHIVE_BYTES, so
memory is bounded by one archive and one record.  Archives go out through
Spark's text writer, whose commit protocol makes a retried task's files replace
the lost ones on any file system Spark can write: a text row is written byte
for byte, followed by the separator, which is set to the byte 0.  Every archive
ends in that byte (the last byte of a member whose record is below 16 MiB; a
small closing record is added where needed), so rows without their last byte
give exact archives.

Reading.  Each archive is read front to back in CHUNK-sized pieces: the gzip
members are decompressed incrementally, a record's block is framed by its
Content-Length, and block and payload digests are verified.  An archive above
ROW_BYTES (ours never are) does not come as a row: its task opens the path and
reads it as a stream, so memory is bounded by a record, not by an archive.  For
that the file system must be one that pyarrow opens (local or mounted, HDFS, S3,
GCS); smaller archives are read on any that Spark reads.  `check_revisits` holds
what a revisit claims against the response it names.

The join that finds the responses is keyed by payload; a payload that a third
of all rows share is split by adaptive execution.

Defined cases: a null payload is empty; a null id sorts after all others, and
if all ids of a payload are null each record is a response; rows that repeat id
and payload are each what that id is; a null URL leaves the header out; control
characters in a URL are percent-encoded.  An empty table gives no records.
Other columns are ignored.  A malformed member or frame raises ValueError; a
wrong digest is reported in digest_ok.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_BYTES, CHUNK, OUT_BYTES = 16 << 20, 1 << 16, 4 << 20
#: Archives up to this size are read as one binary row, larger ones as a stream.
ROW_BYTES = 64 << 20
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
          "digest_ok boolean, payload binary")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, name: str, block: bytes, *headers: tuple[str, str], date: str = DATE) -> bytes:
    """One record as one gzip member."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", date), *headers,
             ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    name = "" if page_id is None else str(page_id)
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        return record("revisit", name, http, *headers, date=date)
    return record("response", name, http + payload, *headers, date=date)


def _archives(date: str, archive_bytes: int):
    info = record("warcinfo", "info", b"format: WARC File Format 1.1\r\n", ("Content-Type", "application/warc-fields"), date=date)
    closing = record("metadata", "end", b"end: true\r\n", ("Content-Type", "application/warc-fields"), date=date)

    def closed(parts: list[bytes]) -> pa.RecordBatch:
        if parts[-1][-1]:
            parts.append(closing)
        return pa.record_batch({"archive": pa.array([b"".join(parts)[:-1]], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [info], 0
        for batch in batches:
            columns = [batch[c] for c in ("id", "url", "payload", "first", "revisit")]
            for row in zip(*columns):
                parts.append(page_record(*(x.as_py() for x in row), date))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield closed(parts)
                    parts, size = [info], 0
        if size:
            yield closed(parts)
    return run


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = DATE, archive_bytes: int = ARCHIVE_BYTES) -> None:
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= min_bytes, F.unhex(F.sha2("payload", 256))))
    firsts = rows.filter("key is not null").groupBy(F.col("key").alias("same")).agg(F.min("id").alias("first"))
    joined = (rows.join(firsts, rows["key"] == firsts["same"], "left")
              .select("id", "url", "payload", "first", (F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit")))
    (joined.mapInArrow(_archives(date, archive_bytes), "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("compression", "none").option("maxRecordsPerFile", 1).text(path))


def members(archive: BinaryIO) -> Iterator[bytes]:
    """The decompressed gzip members, one after the other."""
    held = archive.read(CHUNK)
    while held:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            held = held or archive.read(CHUNK)
            if not held:
                raise ValueError("an archive ends inside a gzip member")
            try:
                parts.append(member.decompress(held))
            except zlib.error as e:
                raise ValueError(f"not a gzip member: {e}") from e
            held = member.unused_data if member.eof else member.unconsumed_tail
        yield b"".join(parts)
        held = held or archive.read(CHUNK)


def opened(path: str) -> BinaryIO:
    """An archive as a stream, by its path as Spark writes it (file:/a or scheme://host/a)."""
    system, name = fs.FileSystem.from_uri(quote(re.sub(r"^([a-z][a-z0-9+.-]*):/(?!/)", r"\1:///", path), safe="/:@"))
    return system.open_input_stream(name, compression=None)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a member's record."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = headers.get("content-length", "")
    if not gap or not version.startswith("WARC/1.") or not size.isdigit() or rest[int(size):] != b"\r\n\r\n":
        raise ValueError("a member is not one framed WARC record")
    return headers, rest[:int(size)]


def _page_id(headers: dict[str, str], name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", headers.get(name, ""))
    return int(found[1]) if found else None


def page_row(headers: dict[str, str], block: bytes) -> tuple:
    """A RECORD row of a response or revisit record."""
    http, _, payload = block.partition(b"\r\n\r\n")
    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    size = re.search(rb"(?im)^Content-Length:[ \t]*(\d+)", http)
    whole = headers["warc-type"] == "response"
    ok = headers.get("warc-block-digest") == f"sha1:{digest(block)}"
    if whole:
        ok = ok and digest(payload) == told and size is not None and int(size[1]) == len(payload)
    return (_page_id(headers, "warc-record-id"), headers.get("warc-target-uri"), headers["warc-type"], _page_id(headers, "warc-refers-to"),
            int(size[1]) if size else len(payload), told, ok, payload if whole else None)


def _records(archives: Iterator[BinaryIO]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary())
    rows, size = [], 0

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for archive in archives:
        with archive:
            for member in members(archive):
                headers, block = parsed(member)
                if headers.get("warc-type") not in ("response", "revisit"):
                    continue
                rows.append(page_row(headers, block))
                size += len(block)
                if size >= OUT_BYTES or len(rows) >= 4096:
                    yield out()
                    rows, size = [], 0
    if rows:
        yield out()


def _from_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _records(pa.BufferReader(content.as_buffer()) for batch in batches for content in batch["content"])


def _from_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _records(opened(path.as_py()) for batch in batches for path in batch["path"])


def read_archives(spark: SparkSession, path: str, row_bytes: int = ROW_BYTES) -> DataFrame:
    """A RECORD row for each response and revisit record of the archives under path."""
    files = spark.read.format("binaryFile").load(path)        # both filters reach the scan; a column it need not give is not read
    small = files.filter(F.col("length") <= row_bytes).select("content").mapInArrow(_from_rows, RECORD)
    return small.unionByName(files.filter(F.col("length") > row_bytes).select("path").mapInArrow(_from_paths, RECORD))


def check_revisits(records: DataFrame) -> DataFrame:
    """records with refers_ok: for a revisit, whether they hold a sound response of
    the id it refers to with the payload digest it claims; null for a response.
    Pass records that are written, and without payload: they are read twice, and a
    revisit's row is shuffled."""
    sound = (records.filter("record_type = 'response' and digest_ok and page_id is not null")
             .select(F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest")).distinct())
    same = (F.col("refers_to") == F.col("__id")) & (F.col("payload_digest") == F.col("__digest"))
    held = records.filter("record_type = 'revisit'").join(sound, same, "left").select(*records.columns, F.col("__id").isNotNull().alias("refers_ok"))
    return records.filter("record_type = 'response'").withColumn("refers_ok", F.lit(None).cast("boolean")).unionByName(held)
