"""Operators the reference specifies in its design documents but did not
code (EXT-01..EXT-03; EXT-04 lives in Params + trends + policy).

All are aggregates over the decided records (`wide`): conditional counts in
one pass, no long table and no record-level join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import confidence_label, confidence_rank
from ledgerline.operators.policy import _fired, policy_confidence

OTHER_ISSUES = "All other issues"   # FIXED VALUE: residual label


def _stack_policies(df: DataFrame, keep: list[str], per_policy: list[str]) -> DataFrame:
    """Unpivot columns named `{name}_{i}` (i = policy index) to one row per policy."""
    n = len(fixed.POLICY_IDS)
    parts = ", ".join(f"'{pid}', " + ", ".join(f"`{c}_{i}`" for c in per_policy)
                      for i, pid in enumerate(fixed.POLICY_IDS))
    return df.selectExpr(*keep, f"stack({n}, {parts}) AS (policy_id, {', '.join(per_policy)})")


def qualification_matrix(wide: DataFrame, top_issues: int = 12,
                         limited_products: tuple[str, ...] = ()) -> DataFrame:
    """EXT-01: product x issue x policy -> evaluated, triggered, rate,
    qualified (triggered records whose pattern is QUALIFIED), weakest
    confidence, snapshot and coverage dates.  Issues beyond the top
    `top_issues` of a product (by records) are folded into one residual row,
    so denominators still add up to the population."""
    qualified = F.col("issue_pattern_status") == fixed.QUALIFIED
    aggs = [F.count(F.lit(1)).alias("evaluated_count"), F.max("source_snapshot_date").alias("snapshot_date"),
            F.min("complaint_received_date").alias("coverage_min_date"),
            F.max("complaint_received_date").alias("coverage_max_date")]
    for i, (pid, _, _, _, conf, _) in enumerate(fixed.POLICIES):
        aggs += [F.count_if(_fired(pid)).alias(f"t_{i}"),
                 F.count_if(_fired(pid) & qualified).alias(f"q_{i}"),
                 F.min(F.when(_fired(pid), confidence_rank(policy_confidence(pid, conf, limited_products))))
                 .alias(f"r_{i}")]
    per_issue = wide.groupBy("product", "issue").agg(*aggs)
    w = Window.partitionBy("product").orderBy(F.desc("evaluated_count"), F.asc("issue"))
    labelled = per_issue.withColumn(
        "issue", F.when(F.row_number().over(w) <= top_issues, F.col("issue")).otherwise(F.lit(OTHER_ISSUES)))
    n = len(fixed.POLICIES)
    folded = labelled.groupBy("product", "issue").agg(
        F.sum("evaluated_count").alias("evaluated_count"), F.max("snapshot_date").alias("snapshot_date"),
        F.min("coverage_min_date").alias("coverage_min_date"), F.max("coverage_max_date").alias("coverage_max_date"),
        *[F.sum(f"t_{i}").alias(f"t_{i}") for i in range(n)], *[F.sum(f"q_{i}").alias(f"q_{i}") for i in range(n)],
        *[F.min(f"r_{i}").alias(f"r_{i}") for i in range(n)])
    long = _stack_policies(folded, ["product", "issue", "evaluated_count", "snapshot_date", "coverage_min_date",
                                    "coverage_max_date"], ["t", "q", "r"])
    return long.select(
        "product", "issue", "policy_id", "evaluated_count", F.col("t").alias("triggered_count"),
        (F.col("t") / F.col("evaluated_count")).alias("trigger_rate"), F.col("q").alias("qualified_count"),
        F.when(F.col("r").isNotNull(), confidence_label("r")).alias("min_confidence"),
        "snapshot_date", "coverage_min_date", "coverage_max_date")


def _ordered_policies():
    return sorted(fixed.POLICIES, key=lambda p: p[0])


def _intersection(count_col: Column, prefix: str, field: int) -> Column:
    """Policies (or their reasons) that fired for every record of the group."""
    vals = [F.when((F.col(f"{prefix}_{fixed.POLICY_IDS.index(p[0])}") == count_col) & (count_col > 0),
                   F.lit(p[field])) for p in _ordered_policies()]
    return F.array_except(F.array(*vals), F.array(F.lit(None).cast("string")))


def decision_queue_aggregate(wide: DataFrame, trends: DataFrame, as_of: dt.date, window_days: int = 90) -> DataFrame:
    """EXT-02: product x issue x priority x action over the current window vs
    the equal prior window, with the latest trend signal of the pair in the
    window; policy ids and reasons are the *intersection* over the group's
    current records (a policy is listed only if it fired for every one)."""
    d = F.col("complaint_received_date")
    end = F.lit(as_of).cast("date")
    start = F.date_sub(end, window_days)
    prior_start = F.date_sub(end, 2 * window_days)
    cur, prior = (d >= start) & (d < end), (d >= prior_start) & (d < start)
    aggs = [F.count_if(cur).alias("record_count"), F.count_if(prior).alias("prior_record_count"),
            F.min(F.when(cur, F.col("min_confidence_rank"))).alias("_rank"),
            F.max(F.when(cur, F.col("recent_publication_lag_flag"))).alias("_any_lag")]
    aggs += [F.count_if(cur & _fired(pid)).alias(f"t_{i}") for i, pid in enumerate(fixed.POLICY_IDS)]
    g = (wide.filter(cur | prior)
             .groupBy("product", "issue", "priority", "recommended_action").agg(*aggs))
    latest = (trends.filter((F.col("metric_date") >= start) & (F.col("metric_date") < end))
                    .groupBy("product", "issue")
                    .agg(F.max_by(F.struct("baseline_volume", "volume_change_pct", "observed_share_pct",
                                           "issue_pattern_status"), F.col("metric_date")).alias("_t")))
    n = F.col("record_count")
    conf = F.when(F.col("_rank").isNotNull(), confidence_label("_rank"))
    out = g.join(latest, ["product", "issue"], "left").select(
        "product", "issue", "priority", "recommended_action", "record_count", "prior_record_count",
        F.when(F.col("prior_record_count") > 0,
               (n - F.col("prior_record_count")) / F.col("prior_record_count")).alias("change_pct"),
        F.col("_t.baseline_volume").alias("baseline_volume"),
        F.col("_t.volume_change_pct").alias("volume_change_pct"),
        F.col("_t.observed_share_pct").alias("observed_share_pct"),
        _intersection(n, "t", 0).alias("triggered_policy_ids"),
        _intersection(n, "t", 3).alias("reason_codes"),
        conf.alias("min_confidence"),
        F.col("_t.issue_pattern_status").alias("issue_pattern_status"),
        F.when(F.col("_any_lag"), F.lit(fixed.LAG_LIMITATION))
         .when(conf == "LIMITED", F.lit(fixed.LIMITED_LIMITATION)).alias("interpretation_limitation"),
        end.alias("window_end"), start.alias("window_start"))
    return out


def critical_policy_tests(queue: DataFrame, rarity_ceiling: float = 0.05) -> DataFrame:
    """EXT-03: failing rows of the documented CRITICAL tests not covered by
    DQ-H: >= 2 HIGH policies, all contributing reasons retained, rarity."""
    crit = queue.filter(F.col("priority") == "CRITICAL")
    ids = F.coalesce(F.col("policy_ids"), F.array().cast("array<string>"))
    reasons = F.coalesce(F.col("reason_codes"), F.array().cast("array<string>"))
    high = [p[0] for p in fixed.POLICIES if p[1] == "HIGH"]
    n_high = sum(F.array_contains(ids, h).cast("int") for h in high)
    needed = ["MULTIPLE_QUALIFIED_TRIGGERS"] + [p[3] for p in fixed.POLICIES if p[1] == "HIGH"]
    missing_reason = F.size(F.array_except(F.array(*[F.lit(r) for r in needed]), reasons)) > 0
    a = crit.filter(n_high < 2).select(F.lit("critical_requires_two_high").alias("check_name"), "complaint_id",
                                       F.lit(None).cast("double").alias("value"))
    b = crit.filter(missing_reason).select(F.lit("critical_retains_all_reasons").alias("check_name"),
                                           "complaint_id", F.lit(None).cast("double").alias("value"))
    share = queue.agg((F.count_if(F.col("priority") == "CRITICAL") / F.count(F.lit(1))).alias("value"))
    c = share.filter(F.col("value") > rarity_ceiling).select(
        F.lit("critical_rarity").alias("check_name"), F.lit(None).cast("string").alias("complaint_id"), "value")
    return a.unionByName(b).unionByName(c)


def critical_share(queue: DataFrame) -> DataFrame:
    """EXT-03 readout: CRITICAL count and share of the queue."""
    return queue.agg(F.count_if(F.col("priority") == "CRITICAL").alias("critical_count"),
                     F.count(F.lit(1)).alias("queue_count")).withColumn(
        "critical_share", F.col("critical_count") / F.col("queue_count"))
