"""Substring dedup: words covered by a word window that starts anywhere else.

Windows are far more numerous than rows, so a count-min sketch decides which
of them are worth grouping:

1. *Prefilter.*  Every window is counted through its anchor, the word gram of
   least hash inside it: equal windows have equal anchors at the same place, so
   a window that occurs twice has an anchor that occurs twice.  A block adds
   its anchors to ROWS sketch rows of 2**CELL_BITS cells, and sends only the
   cells it touched, sorted and Golomb-Rice coded.  Owners of cell ranges merge
   the blocks' sketches and answer for each cell: counted once, or more often.
   The least of a window's cells never counts less than the window, so none is lost.
2. *Exact pass.*  Only windows whose anchor is estimated repeated are hashed to
   128 bits (two independent 64-bit codes of whole words) and grouped; owners
   answer one bit for each code.  Equal codes are taken as equal windows: for
   10**13 windows the chance of any false pair is below 10**-12.
3. The words of the windows found are removed.  Windows are judged on the input.

A block sends a code once however often it holds it, so a passage in a third
of all documents costs an owner one entry per block.  Texts move twice, only
those with a candidate, keyed by document, so no key is hot.

Defined cases: null and wordless texts have no words and an empty kept text;
texts shorter than the window lose nothing; rows that repeat id and text count
as two occurrences and share the result; a null id is carried as null.  Empty
table, empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import exchange as X
from ledgerline.llm.common import stage

GRAM = 8                       # words of an anchor
ROWS, CELL_BITS = 2, 42        # sketch: rows, and cells of a row (kept sparse)
BLOCK, DOCS = 1 << 18, 1 << 16  # codes and documents of a block
CHUNK = 1 << 20                # text bytes hashed at once
WORDS = 1 << 18
_MARKS = "id long, rk long, n_words long, sha string, spots binary"
_FOUND = "id long, rk long, spots binary"
_RESULT = "id long, n_words long, n_removed long, sha string"
_STEPS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


class WordCodes(dict):
    """Word -> place of its two 64-bit codes."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_128_intdigest(word)
        self.high.append(code >> 64)
        self.low.append(code & 0xFFFFFFFFFFFFFFFF)
        self[word] = place = len(self.high) - 1
        return place

    def __init__(self):
        self.high, self.low = array("Q"), array("Q")

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > WORDS:
            self.clear()
            self.high, self.low = array("Q"), array("Q")
        places = np.fromiter((self[w] for words in texts for w in words), np.int64, sum(map(len, texts)))
        return np.array(self.high, np.uint64)[places], np.array(self.low, np.uint64)[places]


def rolling(codes: np.ndarray, n: int, which: int) -> np.ndarray:
    """A code for every n consecutive word codes: a polynomial modulo 2**64."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    step = _STEPS[which]
    back = np.uint64(pow(int(step), -1, 1 << 64))
    power, inverse = (np.cumprod(np.r_[np.uint64(1), np.full(len(codes) - 1, x, np.uint64)]) for x in (step, back))
    total = np.r_[np.uint64(0), np.cumsum(codes * power, dtype=np.uint64)]
    return (total[n:] - total[:-n]) * inverse[:len(codes) - n + 1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Chunk:
    """Windows and anchors of a few texts at once."""

    def __init__(self, texts: list[list[bytes]], known: WordCodes, size: int):
        self.high, self.low = known.of(texts)
        self.counts = np.array([len(t) for t in texts], np.int64)
        self.first = np.r_[0, np.cumsum(self.counts)]
        doc = np.repeat(np.arange(len(texts)), self.counts)
        last = max(0, len(doc) - size + 1)
        whole = np.flatnonzero(doc[:last] == doc[size - 1:]) if last else np.empty(0, np.int64)
        self.grams = mixed(rolling(self.high, min(GRAM, size), 0))
        if len(whole):
            views = np.lib.stride_tricks.sliding_window_view(self.grams, size - min(GRAM, size) + 1)
            self.anchor = whole + views.argmin(axis=1)[whole]
        else:
            self.anchor = whole
        self.window, self.doc = whole, doc


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[list[bytes]]]]:
    """((id, rk, spots) of each row, words of each row) of about CHUNK bytes."""
    rows, texts, size = [], [], 0
    for batch in batches:
        spots = batch["spots"].to_pylist() if "spots" in batch.schema.names else [None] * batch.num_rows
        for key, text in zip(zip(batch["id"].to_pylist(), batch["rk"].to_pylist(), spots), batch["text"]):
            raw = text.as_py()
            rows.append(key)
            texts.append(raw.split())
            size += len(raw)
            if size >= CHUNK:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


class Block:
    """Codes of whole documents, staged when there are enough of them."""

    def __init__(self, code_bits: int, owners: int):
        self.code_bits, self.owners = code_bits, owners
        self.unit = TaskContext.get().partitionId() << 24
        self.docs, self.counts, self.spots, self.codes, self.n = [], [], [], [], 0

    def add(self, docs: list[tuple], counts: np.ndarray, spots: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.docs += docs
        self.counts.append(counts)
        self.spots.append(spots)
        self.codes.append(codes)
        self.n += len(codes)
        if self.n >= BLOCK or len(self.docs) >= DOCS:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        counts, spots, codes = (np.concatenate(x) for x in (self.counts, self.spots, self.codes))
        # Places rise by small steps, mostly one, so their steps pack well.
        steps = np.frombuffer(zlib.compress(np.diff(spots, prepend=0).astype("<i4").tobytes(), 1), np.uint8)
        out = X.block_rows(self.unit, codes, self.code_bits, self.owners, pickle.dumps(self.docs), counts.astype("<i4"), steps)
        self.unit += 1
        self.docs, self.counts, self.spots, self.codes, self.n = [], [], [], [], 0
        return out

    @staticmethod
    def read(kept: bytes) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        place, counts, steps = X.unpack_arrays(kept, "<u4", "<i4", "u1")
        spots = np.cumsum(np.frombuffer(zlib.decompress(steps.tobytes()), "<i4"))
        return pickle.loads(kept[24 + place.nbytes + counts.nbytes + steps.nbytes:]), place, counts, spots


def _anchors(size: int, owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = WordCodes(), Block(CELL_BITS + 1, owners)
        for rows, texts in _chunks(batches):
            chunk = Chunk(texts, known, size)
            spots = np.unique(chunk.anchor)
            code, doc = chunk.grams[spots], chunk.doc[spots]
            shift = np.uint64(64 - CELL_BITS)
            cells = [(code if r == 0 else mixed(code + np.uint64(r))) >> shift | np.uint64(r << CELL_BITS) for r in range(ROWS)]
            yield from block.add([(k[0], k[1], len(t), _sha(t)) for k, t in zip(rows, texts)],
                                 np.bincount(doc, minlength=len(texts)), spots - chunk.first[doc],
                                 np.stack(cells, axis=1).reshape(-1))
        if block.docs:
            yield block.flush()
    return run


def _candidates(kept: bytes, flags: np.ndarray) -> pd.DataFrame:
    docs, place, counts, spots = Block.read(kept)
    hit = flags[place].reshape(-1, ROWS).all(axis=1)        # the least of the cells counts twice
    parts = np.split(np.where(hit, spots, -1), np.cumsum(counts)[:-1])
    out = [(p[p >= 0]).astype("<i4").tobytes() for p in parts]
    frame = pd.DataFrame(docs, columns=["id", "rk", "n_words", "sha"])
    return frame.assign(id=frame["id"].astype("Int64"), spots=[x or None for x in out])


def _windows(size: int, owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = WordCodes(), Block(64, owners)
        for rows, texts in _chunks(batches):
            chunk = Chunk(texts, known, size)
            flagged = np.concatenate([np.frombuffer(r[2], "<i4") + first for r, first in zip(rows, chunk.first)])
            wanted = np.zeros(len(chunk.high) + 1, bool)
            wanted[flagged] = True
            windows = chunk.window[wanted[chunk.anchor]]
            codes = np.stack([rolling(chunk.high, size, 0)[windows], rolling(chunk.low, size, 1)[windows]], axis=1)
            doc = chunk.doc[windows]
            yield from block.add([r[:2] for r in rows], np.bincount(doc, minlength=len(texts)), windows - chunk.first[doc], codes)
        if block.docs:
            yield block.flush()
    return run


def _found(kept: bytes, flags: np.ndarray) -> pd.DataFrame:
    docs, place, counts, spots = Block.read(kept)
    parts = np.split(np.where(flags[place], spots, -1), np.cumsum(counts)[:-1])
    rows = [(i, rk, p[p >= 0].astype("<i4").tobytes()) for (i, rk), p in zip(docs, parts) if (p >= 0).any()]
    frame = pd.DataFrame(rows, columns=["id", "rk", "spots"])
    return frame.assign(id=frame["id"].astype("Int64"), rk=frame["rk"].astype("int64"))


def covered(n_words: int, starts: np.ndarray, size: int) -> np.ndarray:
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0


def _removed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, spots in zip(batch["id"].to_pylist(), batch["text"], batch["spots"].to_pylist()):
                words = text.as_py().split()
                gone = covered(len(words), np.frombuffer(spots, "<i4").astype(np.int64), size)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                out.append((i, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5,
                                   (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                                  names=["id", "n_words", "n_removed", "sha", "kept"])
    return run


def _texts_of(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """The texts of the documents in keyed (id, rk, spots), each key once; a filter
    sized to them keeps most other texts out of the shuffle."""
    keyed = keyed.groupBy("id", "rk").agg(F.max("spots").alias("spots")).withColumnsRenamed({"id": "kid", "rk": "krk"})
    some = X.possibly_in(rows, "rk", keyed.select(F.col("krk").alias("rk")))
    return some.join(keyed, F.col("id").eqNullSafe(F.col("kid")) & (F.col("rk") == F.col("krk"))).select("id", "rk", "text", "spots")


def substring_dedup(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if with_text, kept_text for
    documents that lost words (null: nothing was removed): one row per input row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t")).select(
        "id", F.xxhash64("t", "id").alias("rk"), F.col("t").cast("binary").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = X.owners_for(n_bytes // 32)
    marks = stage(X.resolved(stage(rows.mapInArrow(_anchors(size, owners.groups), X.STAGED), "substring-anchors"),
                             _candidates, _MARKS, owners, CELL_BITS + 1), "substring-marks")
    candidates = marks.filter("spots is not null").select("id", "rk", "spots")
    windows = stage(_texts_of(rows, candidates).mapInArrow(_windows(size, owners.groups), X.STAGED), "substring-windows")
    found = stage(X.resolved(windows, _found, _FOUND, owners, 64, wide=True), "substring-found")
    cut = _texts_of(rows, found).mapInArrow(_removed(size), _RESULT + ", kept binary")
    losers = found.select(F.col("id").alias("kid"), F.col("rk").alias("krk")).distinct()
    whole = marks.join(losers, F.col("id").eqNullSafe(F.col("kid")) & (F.col("rk") == F.col("krk")), "left_anti").select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"), "sha", F.lit(None).cast("binary").alias("kept"))
    out = whole.unionByName(cut).select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("sha").alias("kept_sha256"),
                                        F.col("kept").cast("string").alias("kept_text"))
    return out if with_text else out.drop("kept_text")


#: DuckDB SQL of the whole operator, windows compared as text.
SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, unnest(range(1, len(w) - 33)) AS s FROM docs WHERE len(w) >= 35),
keyed AS (
  SELECT d.r, s, md5(array_to_string(w[s:s + 34], ' ')) AS k FROM windows JOIN docs d USING (r)),
twice AS (
  SELECT r, s FROM keyed WHERE k IN (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1)),
gone AS (
  SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM twice),
words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (r)
"""
