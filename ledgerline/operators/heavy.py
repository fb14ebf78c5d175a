"""Most frequent values without counting all of them (TK-01, TK-05, AG-17).

A column may have as many values as rows, of which a report shows a few.  Every
task keeps a Misra-Gries summary: at most `COUNTERS` values with lower bounds of
their counts, and the most that any value can have lost there (`error`).  Summaries
add up: a value's count lies between the sum of its bounds and that plus the sum
of the errors.  So the values that can be among the k first are those whose upper
bound reaches the k-th lower bound, and a value in no summary has at most the
errors.

If even that is less than the k-th lower bound, no value outside the candidates can
be among the first, and the candidates' exact counts, from a second pass that
groups only their rows, decide.  Else, as in a column of unique values, all values
are grouped: the result is exact either way, ties going to the lesser value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.sinks import staged

COUNTERS = 4096


class Summary:
    """Misra-Gries counts of one column: value -> lower bound, and the error."""

    def __init__(self, counters: int):
        self.counters, self.counts, self.error = counters, {}, 0

    def add(self, values: pa.Array) -> None:
        found = pc.value_counts(values.drop_null())
        for value, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
            self.counts[value] = self.counts.get(value, 0) + n
        if len(self.counts) > self.counters:                 # take off what leaves `counters` at most
            counts = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            off = int(np.partition(counts, len(counts) - self.counters - 1)[len(counts) - self.counters - 1])
            self.error += off
            self.counts = {v: n - off for v, n in self.counts.items() if n > off}


def _summaries(fields: list[str], counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {f: Summary(counters) for f in fields}
        for batch in batches:
            for f in fields:
                kept[f].add(batch[f])
        rows = [(f, v, n) for f in fields for v, n in kept[f].counts.items()] + [(f, None, kept[f].error) for f in fields if kept[f].error]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), (pa.string(), pa.string(), pa.int64()))],
                              names=["field", "value", "n"])
    return run


def candidates(rows: DataFrame, fields: list[str], k: int, counters: int = COUNTERS) -> tuple[DataFrame, DataFrame]:
    """(field, value) that can be among the k first of the proven fields, and (field,
    proven): whether none else can.  Null and empty values do not count."""
    text = rows.select(*[F.nullif(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    parts = staged(text.mapInArrow(_summaries(fields, counters), "field string, value string, n long"), "heavy-summaries")
    error = parts.filter("value is null").groupBy("field").agg(F.sum("n").alias("error"))
    bounds = parts.filter("value is not null").groupBy("field", "value").agg(F.sum("n").alias("least"))
    first = Window.partitionBy("field").orderBy(F.desc("least"))
    kth = (bounds.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k)       # a group limit: k rows a task
           .groupBy("field").agg(F.min("least").alias("kth"), F.count(F.lit(1)).alias("found")))
    named = parts.sparkSession.createDataFrame([(f,) for f in fields], "field string")
    limits = staged(named.join(kth, "field", "left").join(error, "field", "left")
                    .select("field", F.coalesce("kth", F.lit(0)).alias("kth"), F.coalesce("error", F.lit(0)).alias("error"), F.coalesce("found", F.lit(0)).alias("found")),
                    "heavy-limits")
    proven = (F.col("error") == 0) | ((F.col("found") == k) & (F.col("error") < F.col("kth")))
    # written, so that its size is known: a short list is broadcast to the second pass, which then moves no row
    chosen = staged(bounds.join(limits.filter(proven), "field").filter(F.col("least") + F.col("error") >= F.col("kth")).select("field", "value"), "heavy-candidates")
    return chosen, limits.select("field", proven.alias("proven"))


def top_values(rows: DataFrame, fields: list[str], k: int, counters: int = COUNTERS) -> DataFrame:
    """(field, value, n, rank, by_summary): the k most frequent values of each field,
    exactly; by_summary says whether the summaries proved which can be."""
    chosen, proof = candidates(rows, fields, k, counters)
    proven = {r["field"]: r["proven"] for r in proof.collect()}          # one row for each field
    parts = []
    sure, unsure = [f for f in fields if proven[f]], [f for f in fields if not proven[f]]

    def long(names: list[str]) -> DataFrame:
        pairs = ", ".join(f"'{f}', CAST(`{f}` AS string)" for f in names)
        return rows.selectExpr(f"stack({len(names)}, {pairs}) AS (field, value)").filter("value is not null and value <> ''")

    if sure:
        exact = long(sure).join(chosen, ["field", "value"], "left_semi")
        parts.append(exact.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("by_summary", F.lit(True)))
    if unsure:
        parts.append(long(unsure).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("by_summary", F.lit(False)))
    counts = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    first = Window.partitionBy("field").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).select("field", "value", "n", "rank", "by_summary")
