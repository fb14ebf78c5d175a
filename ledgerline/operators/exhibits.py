"""Population exhibits (AG-08..AG-27, W-04..W-06, PRJ-11/12, TK-01).

Every exhibit is an aggregate over a mart.  Top-k-per-group uses
`row_number() <= k`, which Spark plans as a partial WindowGroupLimit before
the shuffle, so a hot group ships at most k rows per map task.
Per-policy counts are conditional sums in one aggregate (then unpivoted),
not an explode + join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import month_start, safe_divide


def _d(x) -> Column:
    return F.lit(x).cast("date") if not isinstance(x, Column) else x


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """TK-01: ORDER BY ... LIMIT k (TakeOrderedAndProject); callers add a tie-break."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """W-06: first k rows per group (deterministic tie-break is the caller's)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def archive_totals(fct: DataFrame) -> DataFrame:
    """AG-08."""
    return fct.agg(F.count(F.lit(1)).alias("total"),
                   F.min("complaint_received_date").alias("min_date"),
                   F.max("complaint_received_date").alias("max_date"),
                   F.countDistinct("product").alias("distinct_products"))


def monthly_volume(fdm: DataFrame, as_of: dt.date, since: dt.date) -> DataFrame:
    """AG-09: month -> total since `since`, complete months only."""
    return (fdm.filter((F.col("metric_date") >= _d(since)) & (F.col("metric_date") < month_start(_d(as_of))))
               .groupBy(month_start("metric_date").alias("month"))
               .agg(F.sum("daily_complaint_count").alias("total")))


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    """AG-11..13, 15, 16, 23..25: value distribution."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))


def top_products(fct: DataFrame, k: int = 8) -> DataFrame:
    """AG-10."""
    return top_k(count_by(fct, "product"), [F.desc("cnt"), F.asc("product")], k)


def policy_trigger_rates(wide: DataFrame) -> DataFrame:
    """AG-14: per policy triggered / evaluated / rate, from one aggregate of
    conditional counts over the decided records (no 6x long table)."""
    from ledgerline.operators.policy import _fired
    aggs = [F.count(F.lit(1)).alias("evaluated_cnt")]
    for i, pid in enumerate(fixed.POLICY_IDS):
        aggs.append(F.count_if(_fired(pid)).alias(f"t{i}"))
    stacked = ", ".join(f"'{pid}', t{i}" for i, pid in enumerate(fixed.POLICY_IDS))
    return (wide.agg(*aggs)
                .selectExpr(f"stack({len(fixed.POLICY_IDS)}, {stacked}) AS (policy_id, triggered_cnt)",
                            "evaluated_cnt")
                .withColumn("trigger_rate", safe_divide("triggered_cnt", "evaluated_cnt")))


def top_companies(patterns: DataFrame, k: int = 8) -> DataFrame:
    """AG-17: volume only, never a rate."""
    agg = patterns.groupBy("company").agg(F.sum("complaint_count").alias("total"))
    return top_k(agg, [F.desc("total"), F.asc("company")], k)


def month_product(fdm: DataFrame, as_of: dt.date) -> DataFrame:
    """AG-18: (month, product) -> total over complete months."""
    return (fdm.filter(F.col("metric_date") < month_start(_d(as_of)))
               .groupBy(month_start("metric_date").alias("month"), "product")
               .agg(F.sum("daily_complaint_count").alias("total")))


def month_product_issue(fdm: DataFrame, as_of: dt.date) -> DataFrame:
    """AG-26."""
    return (fdm.filter(F.col("metric_date") < month_start(_d(as_of)))
               .groupBy(month_start("metric_date").alias("month"), "product", "issue")
               .agg(F.sum("daily_complaint_count").alias("total")))


def issue_movement(fdm: DataFrame, as_of: dt.date) -> DataFrame:
    """AG-19: trailing 12 complete months vs the 12 before, per (product, issue)."""
    m0 = month_start(_d(as_of))
    d, v = F.col("metric_date"), F.col("daily_complaint_count")
    cur = F.sum(F.when(d >= F.add_months(m0, -12), v).otherwise(0)).alias("current_12m")
    prior = F.sum(F.when((d >= F.add_months(m0, -24)) & (d < F.add_months(m0, -12)), v).otherwise(0)
                  ).alias("prior_12m")
    return (fdm.filter(d < m0).groupBy("product", "issue").agg(cur, prior)
               .filter((F.col("current_12m") > 0) | (F.col("prior_12m") > 0)))


def policy_by_product(cases: DataFrame) -> DataFrame:
    """AG-20: (product, policy) -> triggered, with the product's evaluated
    count.  One aggregate with a conditional count per policy, unpivoted;
    policies that never fire for a product are dropped (as a flatten would)."""
    aggs = [F.count(F.lit(1)).alias("evaluated_count")]
    for i, pid in enumerate(fixed.POLICY_IDS):
        aggs.append(F.count_if(F.coalesce(F.array_contains("policy_ids", pid), F.lit(False))).alias(f"t{i}"))
    stacked = ", ".join(f"'{pid}', t{i}" for i, pid in enumerate(fixed.POLICY_IDS))
    return (cases.groupBy("product").agg(*aggs)
                 .selectExpr("product", f"stack({len(fixed.POLICY_IDS)}, {stacked}) AS (policy_id, triggered_count)",
                             "evaluated_count")
                 .filter(F.col("triggered_count") > 0))


def policy_combos(cases: DataFrame) -> DataFrame:
    """AG-21: exact policy sets; the combos partition the population."""
    combo = F.array_join(F.array_sort("policy_ids"), fixed.COMBO_SEP)
    return cases.groupBy("product", combo.alias("combo")).agg(F.count(F.lit(1)).alias("cnt"))


def weekday_rhythm(fdm: DataFrame, as_of: dt.date) -> DataFrame:
    """AG-22: day totals over the 365 days before the current month, then the
    average per weekday (Sunday = 0)."""
    m0 = month_start(_d(as_of))
    daily = (fdm.filter((F.col("metric_date") >= F.date_sub(m0, 365)) & (F.col("metric_date") < m0))
                .groupBy("metric_date").agg(F.sum("daily_complaint_count").alias("total")))
    return (daily.groupBy((F.dayofweek("metric_date") - 1).alias("dow"),
                          F.date_format("metric_date", "EEE").alias("day_name"))
                 .agg(F.avg("total").alias("avg_total")))


def company_outcomes(fct: DataFrame, k: int | None = 15) -> DataFrame:
    """AG-27 + W-06: per product the k largest handling companies with outcome
    splits; k None: all of them, for roll-ups over several products."""
    r, t = F.col("company_response"), F.col("timely_response_status")
    agg = (fct.filter(F.col("company").isNotNull()).groupBy("product", "company")
              .agg(F.count(F.lit(1)).alias("cnt"),
                   F.count_if(r == "Closed with explanation").alias("explanation_cnt"),
                   F.count_if(r == "Closed with monetary relief").alias("monetary_cnt"),
                   F.count_if(r == "Closed with non-monetary relief").alias("nonmonetary_cnt"),
                   F.count_if(t == "NO").alias("untimely_cnt")))
    return agg if k is None else top_per_group(agg, ["product"], [F.desc("cnt"), F.asc("company")], k)


def latest_signals(trends: DataFrame, as_of: dt.date, weeks: int = 10, k: int = 8) -> DataFrame:
    """W-04: latest qualifying date per (product, issue) in the last `weeks`
    weeks, the k largest changes."""
    recent = trends.filter((F.col("issue_pattern_status") == fixed.QUALIFIED)
                           & (F.col("metric_date") >= F.date_sub(_d(as_of), 7 * weeks)))
    latest = top_per_group(recent, ["product", "issue"], [F.desc("metric_date")], 1)
    return top_k(latest.select("product", "issue", "metric_date", "volume_change_pct", "issue_volume_current"),
                 [F.desc("volume_change_pct"), F.asc("product"), F.asc("issue")], k)


def current_window(cases: DataFrame, as_of: dt.date, window_days: int, lag_days: int) -> DataFrame:
    """PRJ-11: as_of - window <= received < as_of - lag."""
    d = F.col("complaint_received_date")
    return cases.filter((d >= F.date_sub(_d(as_of), window_days)) & (d < F.date_sub(_d(as_of), lag_days)))


def stratified_sample(cases: DataFrame, as_of: dt.date, window_days: int = 180, lag_days: int = 60,
                      per_group: int = 60) -> DataFrame:
    """W-05: newest `per_group` records per (priority, action) in the window;
    complaint_id breaks date ties (the reference's order is not deterministic)."""
    win = current_window(cases, as_of, window_days, lag_days)
    return top_per_group(win, ["priority", "recommended_action"],
                         [F.desc("complaint_received_date"), F.asc("complaint_id")], per_group)


def complete_months(metrics: DataFrame, as_of: dt.date, window_days: int = 180) -> DataFrame:
    """PRJ-12: metric rows in the window, current month kept for action counts only."""
    d = F.col("metric_date")
    return metrics.filter((d >= F.date_sub(_d(as_of), window_days))
                          & ((F.col("metric_name") == "action_count") | (d < month_start(_d(as_of)))))


#: The sets that one scan of the records counts; coarser grains are rolled up from these.
GRAINS = [("month", "product", "issue"), ("product", "state"), ("product", "company_response"), ("product", "submitted_via"),
          ("priority", "signal_confidence", "recommended_action"), ("data_completeness_status", "timely_response_status")]
#: Coarser grains, each from the first set above that holds it.
ROLLED = [(), ("month",), ("month", "product"), ("product",), ("priority",), ("signal_confidence",), ("recommended_action",),
          ("data_completeness_status",), ("timely_response_status",), ("priority", "recommended_action")]


def counted_grains(decided: DataFrame) -> DataFrame:
    """AG-08..16, 18, 23..26 from one narrow scan of the decided records:
    (grain, the columns of all grains, cnt), one row for each combination of each of
    GRAINS, by grouping sets that are counted in each task first."""
    cols = list(dict.fromkeys(c for g in GRAINS for c in g))
    rows = decided.withColumn("month", month_start("complaint_received_date")).select(*cols)
    # a set is told from the others by which columns it leaves out
    left_out = {g: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in g) for g in GRAINS}
    grain = F.grouping_id(*cols)
    out = rows.groupingSets([[F.col(c) for c in g] for g in GRAINS], *cols).agg(F.count(F.lit(1)).alias("cnt"), grain.alias("gid"))
    name = F.coalesce(*[F.when(F.col("gid") == bits, "/".join(g)) for g, bits in left_out.items()])
    return out.select(name.alias("grain"), *cols, "cnt")


def rolled_grain(counted: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """Counts at a grain, from the finest counted set that holds it."""
    source = next(g for g in GRAINS if set(grain) <= set(g))
    rows = counted.filter(F.col("grain") == "/".join(source))
    return rows.select(*grain, "cnt") if grain == source else rows.groupBy(*grain).agg(F.sum("cnt").alias("cnt"))


def all_grains(counted: DataFrame) -> DataFrame:
    """(grain, k1, k2, k3, cnt) for every one of GRAINS and ROLLED."""
    out = None
    for g in [*GRAINS, *ROLLED]:
        keys = [F.col(c).cast("string") for c in g] + [F.lit(None).cast("string")] * (3 - len(g))
        rows = rolled_grain(counted, g).select(F.lit("/".join(g) or "all").alias("grain"), *[k.alias(f"k{i + 1}") for i, k in enumerate(keys)], "cnt")
        out = rows if out is None else out.unionByName(rows)
    return out
