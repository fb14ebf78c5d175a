"""Daily volume and emerging-issue trends (AG-01/02, JN-01/02, W-01..03, DEC-01..03).

Scale notes
-----------
* Records are pre-aggregated to (date, product, issue) before any window:
  the aggregation is partial (map-side) + final, so the only shuffle carries
  one row per (task, date, product, issue).
* Issue windows are partitioned by (product, issue) and ordered by day
  number; a partition holds at most one row per calendar day, so no window
  partition grows with record volume (a hot product only means more keys).
* The all-issue rolling total has no natural partition key.  Instead of an
  unpartitioned window (one task), each daily total is fanned out to the
  `cur + 1` days whose frame contains it and re-aggregated by target day:
  fully distributed, cost proportional to days x window length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import safe_divide, unix_day
from ledgerline.params import Params

KEYS = ["metric_date", "product", "issue"]


def daily_volume(rec: DataFrame) -> DataFrame:
    """AG-01: (date, product, issue) -> complaint_count, lag_flagged_count."""
    return (rec.filter(F.col("complaint_received_date").isNotNull() & F.col("product").isNotNull()
                       & F.col("issue").isNotNull())
               .groupBy(F.col("complaint_received_date").alias("metric_date"), "product", "issue")
               .agg(F.count(F.lit(1)).alias("complaint_count"),
                    F.count_if(F.col("recent_publication_lag_flag")).alias("lag_flagged_count")))


def daily_total(vol: DataFrame) -> DataFrame:
    """AG-02: date -> total_complaint_count."""
    return vol.groupBy("metric_date").agg(F.sum("complaint_count").alias("total_complaint_count"))


def with_daily_total(vol: DataFrame) -> DataFrame:
    """JN-01: daily volume left-joined to the day's total (AQE broadcasts the
    per-day side at runtime; it has one row per calendar day)."""
    return vol.join(daily_total(vol), "metric_date", "left")


def frame_sum(df: DataFrame, value: str, frame: tuple[int, int], out: str,
              by: list[str] | None = None) -> DataFrame:
    """Calendar RANGE-frame sum without a window: each row's value is sent to
    every target day whose frame [d+lo, d+hi] contains it, then summed per
    target.  Returns (by..., metric_date, out) for every target day that has
    at least one contributor; callers join it to the days they need."""
    lo, hi = frame
    by = by or []
    d = F.col("metric_date")
    targets = F.sequence(F.date_sub(d, hi), F.date_sub(d, lo))
    return (df.select(*by, F.explode(targets).alias("metric_date"), F.col(value).alias("_v"))
              .groupBy(*by, "metric_date").agg(F.sum("_v").alias(out)))


def _total_rolled(vol: DataFrame, p: Params) -> DataFrame:
    return frame_sum(daily_total(vol), "total_complaint_count", p.cur_frame, "total_volume_current")


def total_rolling(vol: DataFrame, p: Params) -> DataFrame:
    """W-03: for every day with records, the all-issue total over the current
    window.  Output: metric_date, total_volume_current."""
    days = vol.select("metric_date")
    return _total_rolled(vol, p).join(days, "metric_date", "left_semi")


def issue_windows(vol: DataFrame, p: Params) -> DataFrame:
    """W-01 / W-02: current-window volume and raw baseline per (product, issue)."""
    w = Window.partitionBy("product", "issue").orderBy(unix_day("metric_date"))
    cur_lo, cur_hi = p.cur_frame
    base_lo, base_hi = p.base_frame
    cols = [
        *KEYS, "complaint_count",
        F.sum("complaint_count").over(w.rangeBetween(cur_lo, cur_hi)).alias("issue_volume_current"),
        F.sum("complaint_count").over(w.rangeBetween(base_lo, base_hi)).alias("baseline_volume_raw"),
    ]
    if p.lag_dominance_max is not None:
        cols.append(F.sum("lag_flagged_count").over(w.rangeBetween(cur_lo, cur_hi)).alias("lag_volume_current"))
    return vol.select(*cols)


def with_baseline(df: DataFrame, p: Params) -> DataFrame:
    """DEC-01: raw baseline scaled to the current window length; null for a window of no days."""
    return df.withColumn("baseline_volume",
                         F.col("baseline_volume_raw") / F.nullif(F.lit(p.base), F.lit(0)) * F.lit(p.cur))


def with_change_and_share(df: DataFrame) -> DataFrame:
    """DEC-02: change vs baseline and share of all complaints (fractions)."""
    return (df.withColumn("volume_change_pct",
                          safe_divide(F.col("issue_volume_current") - F.col("baseline_volume"),
                                      F.col("baseline_volume")))
              .withColumn("observed_share_pct",
                          safe_divide("issue_volume_current", "total_volume_current")))


def pattern_status(p: Params):
    """DEC-03: ordered status rules."""
    b, cur, pct = F.col("baseline_volume"), F.col("issue_volume_current"), F.col("volume_change_pct")
    qualifies = pct.isNotNull() & (pct >= p.min_pct)
    if p.lag_dominance_max is not None:
        # EXT-04: the window must not be predominantly lag-flagged.
        qualifies = qualifies & (F.col("lag_volume_current") <= F.lit(p.lag_dominance_max) * cur)
    return (F.when((b < p.min_base) | b.isNull(), fixed.INSUFFICIENT_BASELINE)
             .when(cur < p.min_cur, fixed.NO_SIGNAL)
             .when(qualifies, fixed.QUALIFIED)
             .when(pct.isNotNull() & (pct > 0), fixed.UNQUALIFIED)
             .otherwise(fixed.NO_SIGNAL))


def with_pattern_status(df: DataFrame, p: Params) -> DataFrame:
    return df.withColumn("issue_pattern_status", pattern_status(p))


TREND_COLUMNS = [
    "metric_date", "product", "issue", "daily_complaint_count", "issue_volume_current",
    "baseline_volume", "total_volume_current", "volume_change_pct", "observed_share_pct",
    "issue_pattern_status", "policy_id",
]


def issue_trends(vol: DataFrame, p: Params) -> DataFrame:
    """int_issue_trends: one row per (date, product, issue) with >= 1 record."""
    win = issue_windows(vol, p)
    # JN-02: every trend day has a rolled total (its own day contributes).
    joined = win.join(_total_rolled(vol, p), "metric_date", "left")
    out = with_pattern_status(with_change_and_share(with_baseline(joined, p)), p)
    return out.select(
        "metric_date", "product", "issue",
        F.col("complaint_count").alias("daily_complaint_count"),
        "issue_volume_current", "baseline_volume", "total_volume_current",
        "volume_change_pct", "observed_share_pct", "issue_pattern_status",
        F.lit(fixed.TREND_POLICY_ID).alias("policy_id"),
    )


def daily_metrics(trends: DataFrame) -> DataFrame:
    """PRJ-10: metric layer = trends + generated_at."""
    return trends.select(*TREND_COLUMNS, F.current_timestamp().alias("generated_at"))


def company_patterns(rec: DataFrame) -> DataFrame:
    """AG-03 + PRJ-13: (date, company, product, issue) -> count, fixed LIMITED."""
    return (rec.filter(F.col("company").isNotNull() & F.col("product").isNotNull()
                       & F.col("issue").isNotNull())
               .groupBy(F.col("complaint_received_date").alias("metric_date"), "company", "product", "issue")
               .agg(F.count(F.lit(1)).alias("complaint_count"))
               .withColumn("signal_confidence", F.lit("LIMITED"))
               .withColumn("interpretation_limitation", F.lit(fixed.COMPANY_LIMITATION)))
