"""Salted shuffle join for a side whose hot keys adaptive execution should not have to split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_left_join(big: DataFrame, small: DataFrame, keys: list[str], buckets: int = 16,
                     salt_cols: list[str] | None = None) -> DataFrame:
    """Left join of a large, skewed side to a side with one row per key: the big
    side gets a deterministic salt (hash of its row key columns mod `buckets`)
    and the small side is replicated once per salt (`salt_cols`: a row key such
    as the record id; default all columns), so one hot key is spread over
    `buckets` tasks.  Always a sort-merge join; equals the plain left join."""
    salt = "_salt"
    cols = salt_cols or big.columns
    b = big.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int"))
    s = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s.hint("merge"), keys + [salt], "left").drop(salt)
