"""Operations-console operators (AG-28..AG-34, AG-36, AG-37, AG-40, PRJ-15..PRJ-20).

The console's pandas post-processing (group, share, pivot) is expressed as
Spark aggregates so that only final, small results leave the cluster.
Percentages use a scalar subquery for the grand total instead of an
unpartitioned window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import next_step, reason_sentence, title_case


def provenance(fct: DataFrame) -> DataFrame:
    """AG-28."""
    return (fct.groupBy("source_system", "source_url", "source_retrieved_at", "source_snapshot_date")
               .agg(F.count(F.lit(1)).alias("record_count")))


def queue_summary(queue: DataFrame) -> DataFrame:
    """AG-29."""
    return (queue.groupBy("priority", "signal_confidence", "recommended_action", "policy_version",
                          "model_version").agg(F.count(F.lit(1)).alias("cnt")))


def with_pct(df: DataFrame, by: str, cnt: str = "cnt") -> DataFrame:
    """AG-30: one-dimension distribution with % of total (1 dp)."""
    per = df.groupBy(by).agg(F.sum(cnt).alias(cnt))
    total = per.agg(F.sum(cnt)).scalar()
    pct = (F.col(cnt) * 100.0 / total).cast("decimal(38,12)")
    return per.withColumn("pct", F.round(pct, 1).cast("double"))


def pivot_counts(summary: DataFrame, row: str, col: str) -> DataFrame:
    """AG-31: row x col matrix of counts, zero-filled.  The pivot values
    come from the column's closed domain, so no extra job discovers them."""
    values = fixed.ACCEPTED_VALUES[col]
    return summary.groupBy(row).pivot(col, values).agg(F.sum("cnt")).fillna(0)


def reason_distribution(queue: DataFrame) -> DataFrame:
    """AG-32: reason-code occurrences and %."""
    r = queue.select(F.explode("reason_codes").alias("reason_code"))
    return with_pct(r.groupBy("reason_code").agg(F.count(F.lit(1)).alias("cnt")), "reason_code")


def last_n_days(df: DataFrame, n: int, as_of: dt.date, col: str = "metric_date") -> DataFrame:
    """PRJ-18."""
    return df.filter(F.col(col) >= F.date_sub(F.lit(as_of), n))


def trend_volume_by_date(fdm: DataFrame, n: int, as_of: dt.date) -> DataFrame:
    """AG-33 (1/3): daily volume, from the additive daily count (F5)."""
    return last_n_days(fdm, n, as_of).groupBy("metric_date").agg(F.sum("daily_complaint_count").alias("volume"))


def trend_top_products(fdm: DataFrame, n: int, as_of: dt.date, k: int = 10) -> DataFrame:
    """AG-33 (2/3)."""
    agg = last_n_days(fdm, n, as_of).groupBy("product").agg(F.sum("daily_complaint_count").alias("volume"))
    return agg.orderBy(F.desc("volume"), F.asc("product")).limit(k)


def trend_top_qualified(fdm: DataFrame, n: int, as_of: dt.date, k: int = 10) -> DataFrame:
    """AG-33 (3/3): qualified (product, issue) pairs by volume."""
    agg = (last_n_days(fdm, n, as_of).filter(F.col("issue_pattern_status") == fixed.QUALIFIED)
           .groupBy("product", "issue").agg(F.sum("daily_complaint_count").alias("volume")))
    return agg.orderBy(F.desc("volume"), F.asc("product"), F.asc("issue")).limit(k)


def queue_detail(decided: DataFrame, product: str, issue: str, k: int = 10) -> DataFrame:
    """JN-12 / AG-34: decision mix of one product/issue.  Product, issue and
    decision sit on the same decided row, so the queue x fact join on the record
    id comes down to a filter that reaches the scan."""
    agg = (decided.filter((F.col("product") == product) & (F.col("issue") == issue))
           .groupBy("priority", "recommended_action", "signal_confidence", F.array_join("reason_codes", ", ").alias("reasons"))
           .agg(F.count(F.lit(1)).alias("cnt")))
    return agg.orderBy(F.desc("cnt"), "priority", "recommended_action", "signal_confidence", "reasons").limit(k)


def metric_dates(metrics: DataFrame) -> DataFrame:
    """AG-36 (datesFor): distinct dates per metric."""
    return metrics.select("metric_name", "metric_date").distinct()


def dims_by_total(metrics: DataFrame) -> DataFrame:
    """AG-36 (dimensionsFor): dimensions per metric ranked by total."""
    agg = metrics.groupBy("metric_name", "dashboard_dimension").agg(F.sum("metric_value").alias("total"))
    w = Window.partitionBy("metric_name").orderBy(F.desc("total"), F.asc("dashboard_dimension"))
    return agg.withColumn("dimension_rank", F.row_number().over(w))


def daily_values(metrics: DataFrame) -> DataFrame:
    """One row per (metric, date, dimension), staged: all that the bundle reads of the metrics."""
    from ledgerline.sources.sinks import staged
    return staged(metrics.groupBy("metric_name", "metric_date", "dashboard_dimension").agg(F.sum("metric_value").alias("v")), "metric-values")


def series_metrics(metrics: DataFrame) -> DataFrame:
    """PRJ-20: metrics spanning at least two dates."""
    n = metrics.groupBy("metric_name").agg(F.countDistinct("metric_date").alias("n_dates"))
    return metrics.join(n.filter(F.col("n_dates") >= 2).select("metric_name"), "metric_name", "left_semi")


def metric_bundle(metrics: DataFrame) -> DataFrame:
    """AG-37: per metric (with >= 2 dates) one zero-filled value per (date,
    dimension).  The grid is the feature: per metric the array of its dates is
    spread over each of its dimensions, so no join is keyed by the two or three
    metric names but the one with the values, on all three columns."""
    vals = daily_values(metrics)
    dates = vals.groupBy("metric_name").agg(F.sort_array(F.collect_set("metric_date")).alias("dates")).filter(F.size("dates") >= 2)
    totals = vals.groupBy("metric_name", "dashboard_dimension").agg(F.sum("v").alias("total"))
    w = Window.partitionBy("metric_name").orderBy(F.desc("total"), F.asc("dashboard_dimension"))
    grid = (totals.withColumn("dimension_rank", F.row_number().over(w)).join(dates, "metric_name")
            .select("metric_name", "dashboard_dimension", "dimension_rank", F.explode("dates").alias("metric_date")))
    return (grid.join(vals, ["metric_name", "metric_date", "dashboard_dimension"], "left")
                .select("metric_name", "metric_date", "dashboard_dimension", "dimension_rank",
                        F.coalesce("v", F.lit(0)).alias("value")))


def metric_totals(metrics: DataFrame) -> DataFrame:
    """AG-37 totals: per metric and date across dimensions."""
    return (series_metrics(metrics).groupBy("metric_name", "metric_date")
            .agg(F.sum("metric_value").alias("total")))


def taxonomy_count(dim: DataFrame) -> DataFrame:
    """AG-40."""
    return dim.agg(F.count(F.lit(1)).alias("cnt"))


def taxonomy_products(dim: DataFrame) -> DataFrame:
    return dim.select("product").distinct()


def taxonomy_issues(dim: DataFrame, product: str) -> DataFrame:
    return dim.filter(F.col("product") == product).select("issue").distinct()


def issue_history(fdm: DataFrame, product: str, issue: str) -> DataFrame:
    """PRJ-19: the full series of one (product, issue)."""
    return (fdm.filter((F.col("product") == product) & (F.col("issue") == issue))
               .select("metric_date", "issue_volume_current", "baseline_volume", "volume_change_pct",
                       "observed_share_pct", "issue_pattern_status"))


def latest_of(history: DataFrame) -> DataFrame:
    """PRJ-19 latest row via max_by (no sort of the series)."""
    s = F.struct(*[F.col(c) for c in history.columns])
    return history.agg(F.max_by(s, F.col("metric_date")).alias("r")).select("r.*")


SAMPLE_INDEX_COLS = ["complaint_id", "product", "issue", "priority", "recommended_action",
                     "signal_confidence", "policy_ids"]


def sample_index(cases: DataFrame) -> DataFrame:
    """PRJ-15 (+ FN-23, FN-24): slim projection with readable labels."""
    return cases.select(*SAMPLE_INDEX_COLS,
                        title_case("recommended_action").alias("action_label"),
                        next_step("recommended_action").alias("next_step"),
                        reason_sentence("reason_codes").alias("reason_text"))


def case_by_id(cases: DataFrame, complaint_id: str) -> DataFrame:
    """PRJ-16."""
    return cases.filter(F.col("complaint_id") == complaint_id)


def cases_matching(cases: DataFrame, rules: list[str], members: list[str] | None) -> DataFrame:
    """PRJ-17: records tripping at least one selected rule, within the family."""
    hit = F.coalesce(F.arrays_overlap("policy_ids", F.array(*[F.lit(r) for r in rules])), F.lit(False))
    out = cases.filter(hit)
    return out.filter(F.col("product").isin(members)) if members else out
