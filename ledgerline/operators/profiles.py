"""Stored run profiles and drift against history (DQ-L..DQ-P, DQ-S).

Every load run leaves a profile in the store: for each column its rows and nulls, a
HyperLogLog sketch of its values, for columns of a closed domain the exact count of
each value, and for dates a KLL quantile sketch of day numbers.  Counts add and
sketches merge, so the history of any set of runs is an aggregate over a few rows
for each run and column: comparing a new run with it reads no record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.sinks import staged
from ledgerline.sources.store import Store

TABLE = "profiles"
#: Values of a domain column that a profile keeps; more are counted together.
DOMAIN = 1000
REST = "(other values)"


def profile(rows: DataFrame, run_id: str, columns: list[str], domains: list[str], dates: list[str]) -> DataFrame:
    """(run_id, column, n, nulls, hll, domain, quantiles): one row for each column.
    Sketches and counts in one pass; domain values in one more aggregate."""
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    day = lambda c: F.unix_date(F.try_to_date(F.col(c).cast("string"))).cast("bigint")
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs += [F.count_if(text(c).isNull()).alias(f"nulls_{i}"), F.hll_sketch_agg(text(c)).alias(f"hll_{i}")]
        if c in dates:
            aggs.append(F.kll_sketch_agg_bigint(day(c)).alias(f"kll_{i}"))
    one = rows.agg(*aggs)
    entry = lambda i, c: F.struct(F.lit(c).alias("column"), F.col(f"nulls_{i}").alias("nulls"), F.col(f"hll_{i}").alias("hll"),
                                  (F.col(f"kll_{i}") if c in dates else F.lit(None).cast("binary")).alias("quantiles"))
    flat = one.select("n", F.explode(F.array(*[entry(i, c) for i, c in enumerate(columns)])).alias("e")).select("n", "e.*")
    pairs = ", ".join(f"'{c}', trim(CAST(`{c}` AS string))" for c in domains)
    values = staged(rows.selectExpr(f"stack({len(domains)}, {pairs}) AS (column, value)").filter("value is not null and value <> ''")
                    .groupBy("column", "value").agg(F.count(F.lit(1)).alias("c")), "profile-values")
    first = Window.partitionBy("column").orderBy(F.desc("c"), "value")
    kept = values.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= DOMAIN).select("column", "value", "c")     # a group limit: DOMAIN rows a task
    both = values.select("column", "c").unionByName(kept.select("column", (-F.col("c")).alias("c")))
    rest = both.groupBy("column").agg(F.sum("c").alias("c")).filter("c > 0").select("column", F.lit(REST).alias("value"), "c")
    kept = kept.unionByName(rest).groupBy("column", "value").agg(F.sum("c").alias("c"))
    domain = kept.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("value", "c"))).alias("domain"))        # DOMAIN + 1 entries at most
    return flat.join(domain, "column", "left").select(F.lit(run_id).alias("run_id"), "column", "n", "nulls", "hll", "domain", "quantiles")


def keep(store: Store, profiled: DataFrame, run_id: str) -> int:
    """Add a run's profile to the store; a run has one."""
    return store.append(TABLE, store.write(profiled.coalesce(1), run_id))


def merged(profiles: DataFrame) -> DataFrame:
    """The profile of all these runs together, one row for each column."""
    counts = profiles.select("column", F.explode("domain")).groupBy("column", "key").agg(F.sum("value").alias("c"))
    domain = counts.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("key", "c"))).alias("domain"))
    return (profiles.groupBy("column").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.hll_union_agg("hll").alias("hll"),
                                           F.kll_merge_agg_bigint("quantiles").alias("quantiles"))
            .join(domain, "column", "left"))


def drift(store: Store, run_id: str, earlier: list[str], null_margin: float = 0.01, distinct_margin: float = 0.25, days_margin: int = 30) -> DataFrame:
    """A run against the merged history of earlier ones, one row for each column:
    rows, null rates, domain values that are new or gone, and whether null rate,
    number of distinct values or median day moved by more than a margin."""
    now = merged(store.read(TABLE, keys=[run_id]))
    past = merged(store.read(TABLE, keys=earlier)).select("column", *[F.col(c).alias(f"past_{c}") for c in ("n", "nulls", "hll", "quantiles", "domain")])
    both = now.join(past, "column", "left")
    rate = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    median = lambda c: F.when(F.kll_sketch_get_n_bigint(c) > 0, F.kll_sketch_get_quantile_bigint(c, F.lit(0.5)))
    apart = lambda a, b: F.sort_array(F.array_except(F.coalesce(F.map_keys(a), F.array().cast("array<string>")),
                                                      F.coalesce(F.map_keys(b), F.array().cast("array<string>"))))
    distinct, before = F.hll_sketch_estimate("hll"), F.hll_sketch_estimate("past_hll")
    return both.select(
        F.lit(run_id).alias("run_id"), "column", F.col("n").alias("row_count"), F.col("past_n").alias("history_rows"),
        rate("nulls", "n").alias("null_rate"), rate("past_nulls", "past_n").alias("history_null_rate"),
        apart("domain", "past_domain").alias("new_values"), apart("past_domain", "domain").alias("gone_values"),
        (F.abs(rate("nulls", "n") - rate("past_nulls", "past_n")) > null_margin).alias("null_rate_moved"),
        (F.abs(distinct / before - 1) > distinct_margin).alias("distinct_moved"),
        (F.abs(median("quantiles") - median("past_quantiles")) > days_margin).alias("median_day_moved"))
