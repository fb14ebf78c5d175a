"""Queries for the operators the reference specifies but did not code (EXT-01..04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import round6
from ledgerline.operators import extensions as ext
from ledgerline.params import ORDERS_PARAMS as P
from ledgerline.plans.oracle import COVERAGE_TEXT, LAG_TEXT, conf_label, conf_rank, orders_sql
from ledgerline.plans.pipeline import Pipeline
from ledgerline.plans.q_core import QUEUE_OUT, TREND_SQL, _trend_out, j, r6
from ledgerline.plans.registry import register
from ledgerline.plans.seeded import both, both_sql

# The fixture has five issues per product; fold beyond the top three so the
# residual row is exercised (the reference's export default is 12).
TOP_ISSUES = 3
WINDOW_DAYS = 90
GATED = P.with_(lag_dominance_max=0.5, limited_products=("BUILDING",))


QM_SQL = f"""
, pe AS (SELECT s.product, s.issue, s.complaint_received_date AS d, s.source_snapshot_date AS snap,
           s.issue_pattern_status AS st, p.policy_id, coalesce(p.triggered, false) AS trig, p.signal_confidence
         FROM policies p JOIN signals s ON p.complaint_id = s.complaint_id)
, ir AS (SELECT product, issue, row_number() OVER (PARTITION BY product ORDER BY count(*) DESC, issue) AS rk
         FROM signals GROUP BY 1, 2)
, lab AS (SELECT pe.*, CASE WHEN ir.rk <= {TOP_ISSUES} THEN pe.issue ELSE 'All other issues' END AS issue_label
          FROM pe JOIN ir ON pe.product = ir.product AND pe.issue = ir.issue)
SELECT product, issue_label AS issue, policy_id, count(*) AS evaluated_count, count_if(trig) AS triggered_count,
  {r6('count_if(trig) / CAST(count(*) AS double)', 'trigger_rate')},
  count_if(trig AND st = 'QUALIFIED_SIGNAL') AS qualified_count,
  {conf_label(f"min(CASE WHEN trig THEN {conf_rank('signal_confidence')} END)")} AS min_confidence,
  max(snap) AS snapshot_date, min(d) AS coverage_min_date, max(d) AS coverage_max_date
FROM lab GROUP BY 1, 2, 3
"""


@register("qualification_matrix", lambda: orders_sql(QM_SQL), ids="EXT-01")
def q_matrix(spark, sf):
    w = Pipeline.orders(spark, sf).wide
    return ext.qualification_matrix(w, TOP_ISSUES).withColumn("trigger_rate", round6("trigger_rate"))


def _dqa_sql() -> str:
    end = f"DATE '{P.as_of.isoformat()}'"
    start = f"CAST({end} - INTERVAL {WINDOW_DAYS} DAY AS date)"
    pstart = f"CAST({end} - INTERVAL {2 * WINDOW_DAYS} DAY AS date)"
    cur = f"(complaint_received_date >= {start} AND complaint_received_date < {end})"
    # (policy, reason), in policy order
    ordered = [("POLICY_CRITICAL_COMBINATION", "MULTIPLE_QUALIFIED_TRIGGERS"), ("POLICY_EMERGING_ISSUE", "EMERGING_ISSUE_SIGNAL"),
               ("POLICY_INCOMPLETE_CONTEXT", "INCOMPLETE_CONTEXT"), ("POLICY_PUBLICATION_LAG", "RECENT_PUBLICATION_LAG"),
               ("POLICY_STABLE_PATTERN", "STABLE_PATTERN"), ("POLICY_UNTIMELY_RESPONSE", "PUBLISHED_UNTIMELY_RESPONSE")]
    tcols = ", ".join(f"count_if({cur} AND coalesce(list_contains(triggered_policy_ids, '{p[0]}'), false)) "
                      f"AS \"t_{p[0]}\"" for p in ordered)

    def inter(field: int) -> str:
        items = ", ".join(f"CASE WHEN \"t_{p[0]}\" = record_count AND record_count > 0 THEN '{p[field]}' END"
                          for p in ordered)
        return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), '|')"

    return orders_sql(f"""
, g AS (
  SELECT product, issue, priority, recommended_action, count_if({cur}) AS record_count,
    count_if(complaint_received_date >= {pstart} AND complaint_received_date < {start}) AS prior_record_count,
    min(CASE WHEN {cur} THEN min_confidence_rank END) AS rank_,
    bool_or(CASE WHEN {cur} THEN recent_publication_lag_flag END) AS any_lag, {tcols}
  FROM decisions WHERE complaint_received_date >= {pstart} AND complaint_received_date < {end}
  GROUP BY 1, 2, 3, 4)
, latest AS (
  SELECT product, issue, arg_max({{'v': baseline_volume}}, metric_date).v AS baseline_volume,
    arg_max({{'v': volume_change_pct}}, metric_date).v AS volume_change_pct,
    arg_max({{'v': observed_share_pct}}, metric_date).v AS observed_share_pct,
    arg_max({{'v': issue_pattern_status}}, metric_date).v AS issue_pattern_status
  FROM trends WHERE metric_date >= {start} AND metric_date < {end} GROUP BY 1, 2)
SELECT g.product, g.issue, priority, recommended_action, record_count, prior_record_count,
  {r6('CASE WHEN prior_record_count > 0 THEN (record_count - prior_record_count) / CAST(prior_record_count AS double) END', 'change_pct')},
  {r6('l.baseline_volume', 'baseline_volume')}, {r6('l.volume_change_pct', 'volume_change_pct')},
  {r6('l.observed_share_pct', 'observed_share_pct')},
  {inter(0)} AS triggered_policy_ids, {inter(1)} AS reason_codes,
  {conf_label('rank_')} AS min_confidence, l.issue_pattern_status,
  CASE WHEN any_lag THEN '{LAG_TEXT}'
       WHEN {conf_label('rank_')} = 'LIMITED' THEN '{COVERAGE_TEXT}' END AS interpretation_limitation,
  {end} AS window_end, {start} AS window_start
FROM g LEFT JOIN latest l ON g.product = l.product AND g.issue = l.issue
""")


@register("decision_queue_aggregate", _dqa_sql, ids="EXT-02")
def q_dqa(spark, sf):
    pl = Pipeline.orders(spark, sf)
    df = ext.decision_queue_aggregate(pl.wide, pl.trends, P.as_of, WINDOW_DAYS)
    return df.select(*[round6(c).alias(c) if c in ("change_pct", "baseline_volume", "volume_change_pct",
                                                    "observed_share_pct")
                       else F.array_join(c, "|").alias(c) if c in ("triggered_policy_ids", "reason_codes")
                       else F.col(c) for c in df.columns])


RARITY = 0.008


@register("critical_policy_tests", lambda: orders_sql(both_sql(
    lambda x: f"SELECT 'critical_requires_two_high' AS check_name, complaint_id, CAST(NULL AS double) AS value FROM queue{x} WHERE priority = 'CRITICAL' "
              "AND NOT list_has_all(policy_ids, ['POLICY_UNTIMELY_RESPONSE', 'POLICY_EMERGING_ISSUE']) "
              f"UNION ALL SELECT 'critical_retains_all_reasons', complaint_id, NULL FROM queue{x} WHERE priority = 'CRITICAL' AND NOT list_has_all("
              "reason_codes, ['MULTIPLE_QUALIFIED_TRIGGERS', 'PUBLISHED_UNTIMELY_RESPONSE', 'EMERGING_ISSUE_SIGNAL']) "
              f"UNION ALL SELECT 'critical_rarity', NULL, avg(CAST(ifnull(priority, '') = 'CRITICAL' AS double)) FROM queue{x} HAVING "
              f"avg(CAST(ifnull(priority, '') = 'CRITICAL' AS double)) > {RARITY}")), ids="EXT-03")
def q_critical_tests(spark, sf):
    return both(Pipeline.orders(spark, sf), lambda f: ext.critical_policy_tests(f.queue, RARITY))


@register("critical_share", lambda: orders_sql(
    "SELECT count_if(priority = 'CRITICAL') AS critical_count, count(*) AS queue_count, "
    + r6("count_if(priority = 'CRITICAL') / CAST(count(*) AS double)", "critical_share") + " FROM queue"),
    ids="EXT-03 (readout)")
def q_critical_share(spark, sf):
    return ext.critical_share(Pipeline.orders(spark, sf).queue).withColumn("critical_share",
                                                                          round6("critical_share"))


@register("ext_gated_trends", lambda: orders_sql(TREND_SQL, GATED), ids="EXT-04 (lag-dominance gate)")
def q_gated_trends(spark, sf):
    return _trend_out(Pipeline.orders(spark, sf, GATED).trends)


def _gated_queue_sql() -> str:
    cols = [j(c, c) if c in ("reason_codes", "policy_ids") else c for c in QUEUE_OUT]
    return orders_sql("SELECT " + ", ".join(cols) + " FROM queue", GATED)


@register("ext_gated_queue", _gated_queue_sql, ids="EXT-04 (flagged-category LIMITED)")
def q_gated_queue(spark, sf):
    q = Pipeline.orders(spark, sf, GATED).queue
    return q.select(*[F.array_join(c, "|").alias(c) if c in ("reason_codes", "policy_ids") else F.col(c)
                      for c in QUEUE_OUT])



