"""One large multi-line CSV file read by many tasks (SRC-01, SRC-08).

A quoted field may hold line breaks, so whether a line starts a record depends on
all quotes before it, and Spark's multi-line reader therefore takes a whole file
in one task.  Here the file is read in blocks, as Spark splits it, and
the dependence is one bit for each block:

1. every block gets a number and counts its quotes; the running parity over a file's blocks says
   which of them begin inside a quoted field (an escaped quote counts two, and so
   changes nothing);
2. a second pass over the text, knowing that bit, cuts it into records.  The
   line before which the parity is even starts a record;
3. what a block holds of a record that began before it, and its last record if
   that goes on behind it, are fragments, at most two for each block; they are
   written by a pass of their own and put together by the block in which their record started.
   Whole records are not written: they go on as they are cut, so a file's text is
   not on disk a second time, and each action on the records reads the file again.

Records then go through Spark's CSV parser with the options of the plain reader,
and every file's first record is held against the contract's header.

A block of a plain file is lines.  A file whose name ends in `.bgz` is block-gzipped (BGZF, as bgzip
writes it): gzip members of at most 64 KB of text, all with the same first 16
bytes.  With these as the separator Spark's text reader splits the file between
members, and a block is the text of its members, which may begin and end anywhere in a
line.  `write_one_file` writes such a file.  Other compressed files are one block each.

Numbers and bits are broadcast for the blocks of one group of files; a group ends before it
has more than `BLOCKS` blocks (a single file may have more: as many as its size
takes).  Files whose quotes do not pair up, or that have a quote inside an
unquoted field, are not CSV by RFC 4180: the parity then shifts and the records
come out malformed, in `_corrupt`, as far as they do.  A member that is damaged
stops the read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: Blocks (of 128 MB by default) whose starting bit is broadcast at once.
BLOCKS = 100_000
WHOLE, HEAD, TAIL = 0, 1, 2
_PIECES = "code long, kind int, first boolean, text binary"

#: Block-gzipped files: the ending of their names, what every member begins with, an empty member (it ends a
#: file and may stand between others), the most text of a member, and members unpacked at once.
GZIPPED = ".bgz"
MARK = bytes.fromhex("1f8b08040000000000ff060042430200")
EMPTY = MARK + bytes.fromhex("1b0003000000000000000000")
MEMBER, AT_ONCE = 0xFF00, 32
_LATIN = "ISO-8859-1"      # a character for each byte


def file_sizes(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """The files that Spark reads under these paths, with their lengths."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in spark.read.text(paths).inputFiles():
        path = hadoop.Path(spark.sparkContext._jvm.java.net.URI(name))
        out.append((path.toString(), path.getFileSystem(conf).getFileStatus(path).getLen()))
    return out


def _groups(files: list[tuple[str, int]], block_bytes: int, most: int) -> Iterator[list[str]]:
    group, n = [], 0
    for name, size in files:
        blocks = 1 + size // block_bytes
        if group and n + blocks > most:
            yield group
            group, n = [], 0
        group.append(name)
        n += blocks
    if group:
        yield group


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(files)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def _members(spark: SparkSession, files: list[str]) -> DataFrame:
    """The members of block-gzipped files, without `MARK`; empty ones are left out."""
    parts = spark.read.option("lineSep", MARK.decode(_LATIN)).option("encoding", _LATIN).text(files)
    return (parts.filter(F.octet_length("value") > len(EMPTY) - len(MARK))
            .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def _zipped(text: bytes) -> bytes:
    packer = zlib.compressobj(wbits=-15)
    body = packer.compress(text) + packer.flush()
    return MARK + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little")


def _unzipped(member: bytes) -> bytes:
    """The text of a member; raises if it is not one whole, sound member."""
    try:
        text = zlib.decompress(member[2:-8], -15)
    except zlib.error as e:
        raise ValueError(f"not a block-gzip member: {e}") from e
    if member[:2] != (len(member) + 15).to_bytes(2, "little") or member[-8:] != zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little"):
        raise ValueError("not a block-gzip member: its size or checksum differs")
    return text


def _of_lines(values: pa.Array) -> Iterator[bytes]:
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.binary())), b"\n")
    yield joined[0].as_py() + b"\n"


def _of_members(values: pa.Array) -> Iterator[bytes]:
    for a in range(0, len(values), AT_ONCE):
        yield b"".join(map(_unzipped, values.slice(a, AT_ONCE).to_pylist()))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        quotes, ends = [], []
        for member in batch["value"]:
            text = _unzipped(member.as_py())
            quotes.append(text.count(b'"'))
            ends.append(text.endswith(b"\n") if text else None)
        yield pa.record_batch({"file": batch["file"], "block": batch["block"], "quotes": pa.array(quotes, pa.int64()), "ends": pa.array(ends, pa.bool_())})


def known_blocks(lines: DataFrame) -> DataFrame:
    """(file, block, code) of all blocks: a number of its own, and in its low bits
    whether the block begins inside a line, whether inside a quoted field, and whether it begins its file."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return _numbered(lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes")).withColumn("ends", F.lit(True)))


def known_members(members: DataFrame) -> DataFrame:
    """`known_blocks` of block-gzipped files."""
    counts = members.select("file", "block", "value").mapInArrow(_counted, "file string, block long, quotes long, ends boolean").withColumn("at", F.monotonically_increasing_id())
    return _numbered(counts.filter("ends is not null").groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.max_by("ends", "at").alias("ends")))


def _numbered(blocks: DataFrame) -> DataFrame:
    order = Window.partitionBy("file").orderBy("block")
    inside = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    known = blocks.withColumn("inside", inside).withColumn("ended", F.lag("ends").over(order))      # how the block before ends; null: there is none
    return known.select("file", "block", (F.monotonically_increasing_id() * 8 + F.coalesce(~F.col("ended"), F.lit(False)).cast("int") * 4 + F.col("inside") * 2
                                          + F.col("ended").isNull().cast("int")).alias("code"))


class _Block:
    """The text of one block, in order, cut into records.  `whole`: its whole
    records are wanted, else its fragments."""

    def __init__(self, code: int, whole: bool):
        self.code, self.whole, self.odd = code, whole, code >> 1 & 1
        self.open: list[bytes] = []                          # text of the record that goes on
        self.kind = HEAD if code >> 1 & 3 else WHOLE         # what the open text is the start of
        self.n = 0                                           # records begun

    def text(self, data: bytes) -> Iterator[pa.RecordBatch]:
        chars = np.frombuffer(data, np.uint8)
        quotes, ends = np.flatnonzero(chars == ord('"')), np.flatnonzero(chars == ord("\n"))
        ends = ends[(self.odd + np.searchsorted(quotes, ends)) % 2 == 0]         # of lines that end a record
        self.odd = (self.odd + len(quotes)) % 2
        if not len(ends):
            self.open.append(data)
            return
        yield from self.pieces(lambda: pa.array([b"".join([*self.open, data[:ends[0]]])], pa.binary()), 1, self.kind)
        yield from self.pieces(lambda: self.between(chars, ends), len(ends) - 1, WHOLE)
        self.kind, self.open = WHOLE, [data[ends[-1] + 1:]]

    @staticmethod
    def between(chars: np.ndarray, ends: np.ndarray) -> pa.Array:
        text = np.delete(chars[ends[0] + 1:ends[-1]], ends[1:-1] - ends[0] - 1)
        offsets = (ends - ends[0] - np.arange(len(ends))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])

    def end(self) -> Iterator[pa.RecordBatch]:
        if any(self.open):
            yield from self.pieces(lambda: pa.array([b"".join(self.open)], pa.binary()), 1, TAIL if self.kind == WHOLE else HEAD)

    def pieces(self, texts: Callable[[], pa.Array], m: int, kind: int) -> Iterator[pa.RecordBatch]:
        first = np.zeros(m, bool)
        if kind != HEAD:
            first[:1] = self.code & 1 and self.n == 0
            self.n += m
        if m and (kind == WHOLE) == self.whole:
            yield pa.record_batch({"code": pa.array([self.code] * m, pa.int64()), "kind": pa.array([kind] * m, pa.int32()), "first": pa.array(first), "text": texts()})


def _cut(texts: Callable[[pa.Array], Iterator[bytes]], whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch["code"].to_numpy()
            same = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            for a, b in zip(same, [*same[1:], batch.num_rows]):
                if at is None or at.code != codes[a]:
                    if at is not None:
                        yield from at.end()
                    at = _Block(int(codes[a]), whole)
                for text in texts(batch["value"].slice(int(a), int(b - a))):
                    yield from at.text(text)
        if at is not None:
            yield from at.end()
    return run


def _stitched(fragments: DataFrame) -> DataFrame:
    """Fragments put together, in the order of their blocks, by the record they
    are of: a tail and the heads behind it up to the next tail."""
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)       # a block's head before its tail
    placed = fragments.withColumn("record", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    part = F.struct("block", "kind", "text")
    joined = (placed.groupBy("file", "record").agg(F.bool_or("first").alias("first"), F.sort_array(F.collect_list(part)).alias("parts"))
              .select("file", "first", F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text")))
    # only a record that its file breaks off inside a quoted field has its line's end still
    return joined.withColumn("text", F.when(F.endswith("text", F.lit("\n")), F.left("text", F.length("text") - 1)).otherwise(F.col("text")))


def split_records(spark: SparkSession, path: str | list[str], blocks: int = BLOCKS) -> DataFrame:
    """(file, first, text): every record of the files as text; `first` marks a
    file's first one.  Empty lines between records are none."""
    from ledgerline.sources.sinks import staged

    paths = [path] if isinstance(path, str) else path
    size = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    files, out = file_sizes(spark, paths), None
    for zipped, read, known, texts in ((False, _lines, known_blocks, _of_lines), (True, _members, known_members, _of_members)):
        for group in _groups([f for f in files if f[0].endswith(GZIPPED) == zipped], size, blocks):
            rows = read(spark, group)
            named = F.broadcast(staged(known(rows), "csv-blocks"))      # a row for each block
            # a line goes with its block's number alone: the file's name is longer than most lines
            coded = rows.join(named, ["file", "block"]).select("value", "code")
            fragments = staged(coded.mapInArrow(_cut(texts, False), _PIECES), "csv-fragments")
            pieces = [x.join(named, "code").withColumn("text", F.col("text").cast("string")) for x in (coded.mapInArrow(_cut(texts, True), _PIECES), fragments)]
            records = pieces[0].select("file", "first", "text").unionByName(_stitched(pieces[1]))
            out = records if out is None else out.unionByName(records)
    out = spark.createDataFrame([], "file string, first boolean, text string") if out is None else out
    return out.withColumn("text", F.regexp_replace("text", "\r$", "")).filter("text <> ''")


def first_line(spark: SparkSession, file: str) -> DataFrame:
    """(value): the first line of a file, which is not read further; of a
    block-gzipped one it is sought in the first `AT_ONCE` members, 2 MB of text at most."""
    if not file.endswith(GZIPPED):
        return spark.read.text(file).limit(1)
    text = b"".join(_unzipped(bytes(r["value"])) for r in _members(spark, [file]).select("value").take(AT_ONCE))
    return spark.createDataFrame([(text.partition(b"\n")[0].decode(errors="replace"),)] if text else [], "value string")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        records, out, at = batch["value"].cast(pa.binary()), [], 0
        ends = np.cumsum(pc.binary_length(records).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        while at < len(records):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MEMBER, "right")))
            text = b"\n".join(records.slice(at, to - at).to_pylist()) + b"\n"
            out.append(b"".join(_zipped(text[a:a + MEMBER]) for a in range(0, len(text), MEMBER)))
            at = to
        yield pa.record_batch({"members": pa.array(out, pa.binary())})


def write_one_file(records: DataFrame, path: str, header: str, name: str = f"records.csv{GZIPPED}") -> None:
    """One block-gzipped CSV file, path/name, of a header and the records (column
    `value`).  All tasks make members of whole records; the one that writes the
    file only copies them.  Without records the file is empty."""
    spark = records.sparkSession
    at = scratch_path(spark, "csv-members")
    records.select("value").mapInArrow(_packed, "members binary").write.parquet(at)
    members = spark.read.schema("members binary").parquet(at).coalesce(1)
    head = F.when(F.monotonically_increasing_id() == 0, F.lit(_zipped(header.encode() + b"\n"))).otherwise(F.lit(b""))
    (members.select(F.concat(head, "members").cast("string").alias("value")).write.option("lineSep", EMPTY.decode(_LATIN)).option("encoding", _LATIN)
     .option("compression", "none").option("maxRecordsPerFile", 0).text(path))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    (part,) = (s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    if not fs.rename(part, hadoop.Path(folder, name)):
        raise OSError(f"{part.toString()} could not be named {name}")
    fs.delete(hadoop.Path(at), True)             # the file holds them now


def header_names(line: Column) -> Column:
    """The names in a header line: unquoted, without byte-order mark and carriage return."""
    plain = F.regexp_replace(line, "^﻿|\r$", "")
    fields = F.regexp_extract_all(plain, F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(fields, lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
