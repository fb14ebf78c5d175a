"""Ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.sources.sinks import staged


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with `name` (1, 2, ...) in the given total order: a range-partitioned
    sort, the place inside the partition, and the rows of the partitions before
    it (a running sum over one row for each partition)."""
    placed = staged(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("__mid", 33), F.col("__mid").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(W.orderBy("__part")) - F.col("__n")).alias("__before"))
    return (placed.withColumn("__part", part).join(before, "__part")
            .withColumn(name, (F.col("__before") + place + 1).cast("long")).drop("__part", "__before", "__mid"))
