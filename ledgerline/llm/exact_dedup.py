"""Exact dedup by a Golomb-coded fingerprint exchange.

1. One scan gives each row a 48-bit fingerprint and the SHA-256 of its text.
   Every block of up to 262,144 rows sends its sorted distinct fingerprints,
   Rice-coded per owner (about 4 bytes each), and keeps its ids in a staged table.
2. Owners answer with one bit per fingerprint: occurs more than once, or not.
3. Only *suspects* move text: a second scan passes the rows whose fingerprint
   is in a bitmap of eight bits for each suspect one (`exchange.possibly_in`; at
   most 256 MB) and groups them by the text itself, bytes compared, pre-aggregated
   in each task.  A group of copies holding a third of all rows arrives as one row
   per task.

Defined cases: a null text counts as empty; empty texts are equal to each
other.  A null id never wins over another id; in a group without any id every
row stays, as they cannot be told apart.  Rows that repeat both id and text
are one document: each counts in group_size and they share the verdict.  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import exchange as X
from ledgerline.llm.common import apply_verdicts, stage

CODE_BITS = 48
BLOCK = 1 << 18
_BLOCKS = ("unit long, owner int, n int, codes binary, multi binary, "
           "starts binary, ids array<long>, shas array<binary>")
_MARKS = "id long, sha binary, fp long, suspect boolean"


def fingerprint(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - CODE_BITS)


def _blocks(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, rows = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                if rows + piece.num_rows > BLOCK:
                    yield _block(held, (part << 24) + block, owners)
                    held, rows, block = [], 0, block + 1
                held.append(piece)
                rows += piece.num_rows
        if rows:
            yield _block(held, (part << 24) + block, owners)
    return run


def _block(batches: list[pa.RecordBatch], unit: int, owners: int) -> pa.RecordBatch:
    t = pa.Table.from_batches(batches).combine_chunks()
    fp = t["fp"].to_numpy().astype(np.uint64)
    order = np.argsort(fp, kind="stable")
    fp, ids, shas = fp[order], t["id"].take(order).combine_chunks(), t["sha"].take(order).combine_chunks()
    starts = np.r_[True, fp[1:] != fp[:-1]]
    codes = fp[starts]
    multi = np.diff(np.r_[np.flatnonzero(starts), len(fp)]) > 1
    owner = X.owner_of(codes, CODE_BITS, owners)
    row_owner = X.owner_of(fp, CODE_BITS, owners)
    out = {k: [] for k in ("unit", "owner", "n", "codes", "multi", "starts")}
    cuts = [0]
    for o in np.unique(owner):
        a, b = np.searchsorted(owner, [o, o + 1])
        c, d = np.searchsorted(row_owner, [o, o + 1])
        for k, v in zip(out, (unit, int(o), int(b - a), X.rice_encode(codes[a:b]), X.bits_of(multi[a:b]), X.bits_of(starts[c:d]))):
            out[k].append(v)
        cuts.append(int(d))
    offsets = pa.array(cuts, pa.int32())
    return pa.record_batch({
        "unit": pa.array(out["unit"], pa.int64()), "owner": pa.array(out["owner"], pa.int32()),
        "n": pa.array(out["n"], pa.int32()), "codes": pa.array(out["codes"], pa.binary()),
        "multi": pa.array(out["multi"], pa.binary()), "starts": pa.array(out["starts"], pa.binary()),
        "ids": pa.ListArray.from_arrays(offsets, _one(ids)), "shas": pa.ListArray.from_arrays(offsets, _one(shas)),
    })


def _one(x) -> pa.Array:
    return pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids, shas = row["ids"].flatten(), row["shas"].flatten()
            n = row["n"][0].as_py()
            entry = np.cumsum(X.flags_of(row["starts"][0].as_py(), len(ids))) - 1
            fp = X.rice_decode(row["codes"][0].as_py(), n)[entry].astype(np.int64)
            suspect = X.flags_of(row["bits"][0].as_py(), n)[entry]
            yield pa.record_batch({"id": ids, "sha": shas, "fp": pa.array(fp), "suspect": pa.array(suspect)})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id (largest id of the equal texts), group_size, kept,
    text_sha256: one row per input row."""
    return _judged(docs, id_col, text_col).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key (of the text), sha, keep_id, group_size, kept: one row per input row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"))
    owners = X.owners_for(docs.count())
    blocks = stage(rows.select("id", fingerprint(F.col("t")).alias("fp"), F.unhex(F.sha2("t", 256)).alias("sha"))
                   .mapInArrow(_blocks(owners.groups), _BLOCKS), "dedup-blocks")
    answers = X.repeated(blocks.select("unit", "owner", "n", "codes", "multi"), owners, CODE_BITS)
    marks = stage(blocks.drop("multi").join(answers.drop("n"), ["unit", "owner"]).mapInArrow(_marks, _MARKS), "dedup-marks")

    suspects = marks.filter("suspect").select("id", "sha", "fp")
    groups = (X.possibly_in(rows.withColumn("fp", fingerprint(F.col("t"))), "fp", marks.filter("suspect").select("fp"))
              .groupBy("fp", "t").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1")
              .select(F.unhex(F.sha2("t", 256)).alias("sha"), "keep_id", "group_size"))
    alone = marks.filter("not suspect").select("id", "sha", "fp", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    linked = (suspects.join(groups, "sha", "left")
              .select("id", "sha", "fp", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).alias("group_size")))
    return alone.unionByName(linked).select("id", F.col("fp").alias("key"), "sha", "keep_id", "group_size",
                                            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each distinct text, with its own columns: the one with the
    largest id; of rows that share id and text any one."""
    judged = _judged(docs, id_col, text_col)
    # a row's verdict depends on its id and text alone, so those name it
    many = judged.filter("group_size > 1").groupBy("id", "key").agg(F.first("kept").alias("one"), F.count(F.lit(1)).alias("n"))
    return apply_verdicts(docs, many.filter("n > 1 or not one"), id_col, fingerprint(F.coalesce(docs[text_col].cast("string"), F.lit(""))))


SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
