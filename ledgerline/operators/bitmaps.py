"""Exact distinct and duplicate ids without an id shuffle (SRC-04, DQ-B, DQ-M,
SET-06).

An id that is a plain numeral is one bit: the ids of one block of 32,768 numbers
make a 4 KB bitmap, built in each task and merged by bitwise or, so what is
shuffled is a bitmap for each block and task, however many rows there are.
Counting bits gives the distinct ids; where a block has more rows than bits it
holds a repeated id, and only the rows of such blocks are grouped to name it.

Ids that are no plain numerals (other characters, leading zeros, over 18 digits)
are grouped as text.  So are numerals of a length at which they lie too far apart,
fewer than `DENSE` to a block on average, as a bitmap would weigh more than they do.
All ways are exact.  Null is no id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.sinks import staged

#: Rows to a 4 KB bitmap from which it weighs less than the ids themselves.
DENSE = 512
#: Ids that one task groups as text: what a table of them takes, some 100 MB.
ROWS = 250_000
BLOCK = 32_768


def numeral(key: Column) -> Column:
    """The number that a plain numeral is, else null."""
    return F.when(key.rlike("^(0|[1-9][0-9]{0,17})$"), key.cast("bigint"))


def _keyed(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    text = F.col(key).cast("string")
    return rows.select(*by, text.alias("key_value"), numeral(text).alias("number")).filter("key_value is not null")


def _sized(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("digits", F.least(F.greatest(F.length("key_value"), F.lit(5)), F.lit(19)))        # all up to 99,999 together: four blocks


def _spans(keyed: DataFrame, by: list[str]) -> DataFrame:
    """(by.., digits, dense, n): which lengths of numeral are dense, and how many rows there are."""
    span = (F.max("number") - F.min("number")) / BLOCK + 1
    return staged(_sized(keyed).groupBy(*by, "digits").agg((F.count("number") >= DENSE * span).alias("dense"), F.count(F.lit(1)).alias("n")), "id-spans")


def _split(keyed: DataFrame, by: list[str], spans: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows for bitmaps, with block; rows for grouping).  Which numerals are dense
    is told for each group and each length of numeral from their span, so a stray
    long id leaves the others dense.  These small rows are written first: the planner
    knows their size, and the ids are not shuffled to meet them."""
    sized, spans = _sized(keyed), _spans(keyed, by) if spans is None else spans
    if by:
        marked = sized.join(spans.select(*by, "digits", "dense"), [*by, "digits"], "left")
    else:
        marked = sized.withColumn("dense", F.col("digits").isin([r["digits"] for r in spans.filter("dense").collect()]))       # 14 lengths at most
    dense = F.col("number").isNotNull() & F.coalesce("dense", F.lit(False))
    drop = ("dense", "digits")
    return (marked.filter(dense).withColumn("block", F.bitmap_bucket_number("number")).drop(*drop), marked.filter(~dense).drop(*drop))


def _counted(ids: DataFrame, by: list[str], spans: DataFrame) -> DataFrame:
    """(by.., key_value, n) of ids grouped as text.  They are dealt out by id first, over
    as many tasks as they need: most occur once, so counting them before would gather
    every id of a task's input."""
    total = spans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    dealt = ids.select(*by, "key_value").repartition(1 + total // ROWS, *by, "key_value")
    return dealt.groupBy(*by, "key_value").agg(F.count(F.lit(1)).alias("n"))


def _blocks(dense: DataFrame, by: list[str]) -> DataFrame:
    """One row for each block: its bits and its rows."""
    return dense.groupBy(*by, "block").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"), F.count(F.lit(1)).alias("n"))


def id_counts(rows: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """(by.., ids, distinct_ids, duplicate_ids): rows with an id, their distinct ids
    and how many rows are over."""
    by = by or []
    keyed = _keyed(rows, by, key)
    spans = _spans(keyed, by)
    dense, other = _split(keyed, by, spans)
    counted = _blocks(dense, by).select(*by, F.bitmap_count("bits").alias("d"), "n")
    grouped = _counted(other, by, spans).select(*by, F.lit(1).cast("long").alias("d"), "n")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return (counted.unionByName(grouped).groupBy(*by).agg(total("n").alias("ids"), total("d").alias("distinct_ids"))
            .withColumn("duplicate_ids", F.col("ids") - F.col("distinct_ids")))


def repeated_ids(rows: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """(by.., key_value, n): the ids that occur more than once."""
    by = by or []
    keyed = _keyed(rows, by, key)
    spans = _spans(keyed, by)
    dense, other = _split(keyed, by, spans)
    hit = staged(_blocks(dense, by).filter(F.col("n") > F.bitmap_count("bits")).select(*by, "block"), "id-blocks")
    suspects = dense.join(hit, [*by, "block"], "left_semi").select(*by, "key_value").unionByName(other.select(*by, "key_value"))
    return _counted(suspects, by, spans).filter("n > 1")


def run_bitmaps(rows: DataFrame, key: str) -> DataFrame:
    """(block, bits): the ids of a run as bitmaps to be kept; those of several runs
    merge by or.  Ids that are no numerals have no bit."""
    dense = _keyed(rows, [], key).filter("number is not null").withColumn("block", F.bitmap_bucket_number("number"))
    return _blocks(dense, []).drop("n")


def merged_distinct(bitmaps: DataFrame) -> DataFrame:
    """One row, distinct_ids, of kept bitmaps: no id is read again."""
    merged = bitmaps.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("distinct_ids"))
