"""Marts: taxonomy dim, fact, daily metrics, signals, ops metrics, agent context
(AG-05..07, JN-03..06, SET-02, DEC-13, PRJ-09/10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.fixed import CASE_COLUMNS, METRIC_COLUMNS, SIGNAL_COLUMNS
from ledgerline.functions import surrogate_key
from ledgerline.operators.conform import FACT_COLUMNS
from ledgerline.operators.policy import context_summary
from ledgerline.params import Params

TAXONOMY_COLS = ["product", "sub_product", "issue", "sub_issue"]


def taxonomy_key():
    return surrogate_key(*TAXONOMY_COLS)


def taxonomy(rec: DataFrame) -> DataFrame:
    """AG-05: distinct 4-column taxonomy with its surrogate key.  The distinct
    is a hash aggregate with map-side partial dedup."""
    return (rec.filter(F.col("product").isNotNull() & F.col("issue").isNotNull())
               .select(*TAXONOMY_COLS).distinct()
               .select(taxonomy_key().alias("issue_taxonomy_key"), *TAXONOMY_COLS))


def attach_taxonomy(rec: DataFrame, dim: DataFrame) -> DataFrame:
    """JN-04: null-safe 4-key left join to the taxonomy (`<=>` is hash-joinable)."""
    d = dim.select(*[F.col(c).alias("_t_" + c) for c in TAXONOMY_COLS], "issue_taxonomy_key")
    cond = ((rec.product == d._t_product) & rec.sub_product.eqNullSafe(d._t_sub_product)
            & (rec.issue == d._t_issue) & rec.sub_issue.eqNullSafe(d._t_sub_issue))
    return rec.join(d, cond, "left").drop(*["_t_" + c for c in TAXONOMY_COLS])


def fact(rec: DataFrame) -> DataFrame:
    """fct_complaints.  The taxonomy key is a pure function of the four
    taxonomy columns and the dim is their distinct set, so the JN-04 join is
    replaced by computing the key in-row: same result, no shuffle."""
    keyed = rec.withColumns({
        "issue_taxonomy_key": F.when(F.col("product").isNotNull() & F.col("issue").isNotNull(),
                                     taxonomy_key()),
        "generated_at": F.current_timestamp(),
    })
    return keyed.select(*FACT_COLUMNS)


def attach_trend(rec: DataFrame, trends: DataFrame, salt_buckets: int = 0) -> DataFrame:
    """JN-03: record x trend, left, on (date, product, issue); the trend side has
    one row per key.  Adaptive execution broadcasts the trend side if its
    measured bytes allow, and splits hot keys otherwise.  With `salt_buckets`
    a salted sort-merge join instead: a hot product, issue and day is spread
    over that many tasks whatever the session's settings."""
    t = trends.select(
        F.col("metric_date").alias("complaint_received_date"), "product", "issue",
        "issue_volume_current", "baseline_volume", "volume_change_pct", "observed_share_pct",
        "issue_pattern_status", F.col("policy_id").alias("trend_policy_id"))
    keys = ["complaint_received_date", "product", "issue"]
    if salt_buckets > 1:
        from ledgerline.operators.joins import salted_left_join
        return salted_left_join(rec, t, keys, salt_buckets, salt_cols=["complaint_id"])
    return rec.join(t, keys, "left")


def signals(wide: DataFrame) -> DataFrame:
    return wide.select(*SIGNAL_COLUMNS)


def volume_metric(fdm: DataFrame) -> DataFrame:
    """one row per date x product x issue, as the reference emits it."""
    return fdm.select("metric_date", F.col("product").alias("dashboard_dimension"),
                      F.lit("complaint_volume").alias("metric_name"),
                      F.col("daily_complaint_count").alias("metric_value"),
                      F.current_timestamp().alias("generated_at"))


def emerging_counts(fdm: DataFrame) -> DataFrame:
    """AG-06: (date, product) -> count of QUALIFIED rows."""
    return (fdm.filter(F.col("issue_pattern_status") == fixed.QUALIFIED)
               .groupBy("metric_date", F.col("product").alias("dashboard_dimension"))
               .agg(F.count(F.lit(1)).alias("metric_value"))
               .select("metric_date", "dashboard_dimension", F.lit("emerging_issue_count").alias("metric_name"),
                       "metric_value", F.current_timestamp().alias("generated_at")))


def action_counts(queue: DataFrame) -> DataFrame:
    """AG-07: (snapshot, action) -> count."""
    return (queue.groupBy(F.col("source_snapshot_date").alias("metric_date"),
                          F.col("recommended_action").alias("dashboard_dimension"))
                 .agg(F.count(F.lit(1)).alias("metric_value"))
                 .select("metric_date", "dashboard_dimension", F.lit("action_count").alias("metric_name"),
                         "metric_value", F.current_timestamp().alias("generated_at")))


def action_totals(counts: DataFrame, p: Params) -> DataFrame:
    """AG-07 from counts of records (source_snapshot_date, recommended_action, n)."""
    return (counts.groupBy(F.coalesce(F.lit(p.snapshot_date).cast("date"), F.col("source_snapshot_date")).alias("metric_date"),
                           F.col("recommended_action").alias("dashboard_dimension"))
                  .agg(F.sum("n").alias("metric_value"))
                  .select("metric_date", "dashboard_dimension", F.lit("action_count").alias("metric_name"),
                          "metric_value", F.current_timestamp().alias("generated_at")))


def ops_metrics(fdm: DataFrame, queue: DataFrame) -> DataFrame:
    """SET-02: union of the three metric families (reference shape, F7)."""
    return volume_metric(fdm).unionByName(emerging_counts(fdm)).unionByName(action_counts(queue))


def ops_metrics_aggregated(fdm: DataFrame, queue: DataFrame) -> DataFrame:
    """F7 alternative: complaint_volume summed to one row per date x product."""
    vol = (fdm.groupBy("metric_date", F.col("product").alias("dashboard_dimension"))
              .agg(F.sum("daily_complaint_count").alias("metric_value"))
              .select("metric_date", "dashboard_dimension", F.lit("complaint_volume").alias("metric_name"),
                      "metric_value", F.current_timestamp().alias("generated_at")))
    return vol.unionByName(emerging_counts(fdm)).unionByName(action_counts(queue))


def agent_context(queue_wide: DataFrame, p: Params) -> DataFrame:
    """DEC-13 (+ DEC-12): one row per record.  Fact, signals and queue all
    derive from the same record row, so instead of re-joining three marts on
    complaint_id (JN-06) the view is projected from the one wide frame."""
    return queue_wide.select(*CASE_COLUMNS).withColumn("context_summary", context_summary(p))


def case_join(fct: DataFrame, sig: DataFrame, queue: DataFrame) -> DataFrame:
    """JN-06 as written in the reference: fact x signals x queue, two left
    joins on complaint_id (all three are keyed by it, so both joins are
    co-partitioned sort-merge joins on one hash partitioning)."""
    s = sig.select("complaint_id", "issue_volume_current", "baseline_volume", "volume_change_pct",
                   "observed_share_pct", "issue_pattern_status")
    a = queue.select("complaint_id", "signal_confidence", "interpretation_limitation", "priority",
                     "recommended_action", "reason_codes", "policy_ids", "generated_at")
    c = fct.drop("generated_at")
    return c.join(s, "complaint_id", "left").join(a, "complaint_id", "left").select(*CASE_COLUMNS)
