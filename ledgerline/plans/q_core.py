"""Core pipeline queries: staging, trends, decisions, marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import round6
from ledgerline.operators import conform, marts, policy, trends
from ledgerline.plans.oracle import events_sql, orders_sql
from ledgerline.plans.pipeline import Pipeline
from ledgerline.plans.registry import register
from ledgerline.sources import layout


def r6(expr: str, alias: str | None = None) -> str:
    return f"cast(round(cast({expr} AS decimal(38,12)), 6) AS double) AS {alias or expr.split('.')[-1]}"


def j(expr: str, alias: str) -> str:
    return f"array_to_string({expr}, '|') AS {alias}"


TREND_DOUBLES = ["baseline_volume", "volume_change_pct", "observed_share_pct"]


def _trend_out(df):
    return df.select(*[round6(c).alias(c) if c in TREND_DOUBLES else F.col(c) for c in trends.TREND_COLUMNS])


TREND_SQL = ("SELECT metric_date, product, issue, daily_complaint_count, issue_volume_current, "
             + r6("baseline_volume") + ", total_volume_current, " + r6("volume_change_pct") + ", "
             + r6("observed_share_pct") + ", issue_pattern_status, policy_id FROM trends")


@register("issue_trends", lambda: orders_sql(TREND_SQL), ids="W-01 W-02 W-03 JN-02 DEC-01 DEC-02 DEC-03")
def q_issue_trends(spark, sf):
    return _trend_out(Pipeline.orders(spark, sf).trends)


@register("events_issue_trends", lambda: events_sql(TREND_SQL), ids="W-01 W-02 DEC-03 (dense fixture)")
def q_events_trends(spark, sf):
    return _trend_out(Pipeline.events(spark, sf).trends)


@register("daily_volume", lambda: orders_sql("SELECT * FROM vol"), ids="AG-01 FN-18")
def q_daily_volume(spark, sf):
    return Pipeline.orders(spark, sf).vol


@register("daily_total", lambda: orders_sql("SELECT * FROM day_totals"), ids="AG-02")
def q_daily_total(spark, sf):
    return trends.daily_total(Pipeline.orders(spark, sf).vol)


@register("daily_with_total", lambda: orders_sql(
    "SELECT v.*, t.total_complaint_count FROM vol v LEFT JOIN day_totals t ON v.metric_date = t.metric_date"),
    ids="JN-01")
def q_daily_with_total(spark, sf):
    return trends.with_daily_total(Pipeline.orders(spark, sf).vol)


@register("total_rolling", lambda: orders_sql("SELECT * FROM day_totals_rolled"), ids="W-03")
def q_total_rolling(spark, sf):
    pl = Pipeline.orders(spark, sf)
    return trends.total_rolling(pl.vol, pl.p)


STG_COLS = ["complaint_id", "complaint_received_date", "cfpb_routing_date", "product", "sub_product", "issue",
            "sub_issue", "company", "state", "zip_code", "submitted_via", "company_response",
            "timely_response_status", "company_public_response", "tags", "has_narrative",
            "source_snapshot_date", "recent_publication_lag_flag"]


@register("staged_records", lambda: orders_sql(f"SELECT {', '.join(STG_COLS)} FROM stg"),
          ids="PRJ-01 PRJ-02 PRJ-03 PRJ-04 PRJ-05 PRJ-06 PRJ-07 FN-01 FN-02 FN-03 FN-04")
def q_staged(spark, sf):
    return Pipeline.orders(spark, sf).staged.select(*STG_COLS)


@register("status_context", lambda: orders_sql(
    "SELECT complaint_id, data_completeness_status, recent_publication_lag_flag FROM ctx"), ids="PRJ-08 FN-08")
def q_status_context(spark, sf):
    return Pipeline.orders(spark, sf).records.select("complaint_id", "data_completeness_status",
                                                     "recent_publication_lag_flag")


@register("company_patterns", lambda: orders_sql(
    "SELECT complaint_received_date AS metric_date, company, product, issue, count(*) AS complaint_count, "
    "'LIMITED' AS signal_confidence FROM ctx WHERE company IS NOT NULL AND product IS NOT NULL "
    "AND issue IS NOT NULL GROUP BY 1, 2, 3, 4"), ids="AG-03 PRJ-13")
def q_company_patterns(spark, sf):
    return Pipeline.orders(spark, sf).patterns.drop("interpretation_limitation")


@register("policy_long", lambda: orders_sql("SELECT * FROM policies"), ids="DEC-04 DEC-05 DEC-06 SET-01")
def q_policy_long(spark, sf):
    return Pipeline.orders(spark, sf).evals


@register("triggered_rollup", lambda: orders_sql(
    "SELECT complaint_id, " + j("triggered_policy_ids", "policy_ids") + ", "
    + j("triggered_reason_codes", "reason_codes") + ", min_confidence_rank, incomplete_triggered, "
    "lag_triggered, critical_triggered, untimely_triggered, emerging_triggered FROM fired_sets"), ids="AG-04")
def q_rollup(spark, sf):
    w = Pipeline.orders(spark, sf).wide
    return (w.filter(F.col("triggered_policy_ids").isNotNull())
             .select("complaint_id", F.array_join("triggered_policy_ids", "|").alias("policy_ids"),
                     F.array_join("triggered_reason_codes", "|").alias("reason_codes"),
                     "min_confidence_rank", "incomplete_triggered", "lag_triggered", "critical_triggered",
                     "untimely_triggered", "emerging_triggered"))


SIG_OUT = [c for c in marts.SIGNAL_COLUMNS]


@register("signals", lambda: orders_sql(
    "SELECT " + ", ".join(r6(c) if c in TREND_DOUBLES else c for c in SIG_OUT) + " FROM signals"), ids="JN-03")
def q_signals(spark, sf):
    s = Pipeline.orders(spark, sf).signals
    return s.select(*[round6(c).alias(c) if c in TREND_DOUBLES else F.col(c) for c in SIG_OUT])


QUEUE_OUT = ["recommendation_id", "complaint_id", "priority", "recommended_action", "reason_codes", "policy_ids",
             "signal_confidence", "interpretation_limitation", "human_review_required",
             "recent_publication_lag_flag", "data_completeness_status", "source_snapshot_date",
             "policy_version", "model_version"]


def _queue_sql():
    cols = [j(c, c) if c in ("reason_codes", "policy_ids") else c for c in QUEUE_OUT]
    return orders_sql("SELECT " + ", ".join(cols) + " FROM queue")


@register("action_queue", _queue_sql, ids="DEC-07 DEC-08 DEC-10 DEC-11 FN-07 FN-08 FN-15")
def q_queue(spark, sf):
    q = Pipeline.orders(spark, sf).queue
    return q.select(*[F.array_join(c, "|").alias(c) if c in ("reason_codes", "policy_ids") else F.col(c)
                      for c in QUEUE_OUT])


EVIDENCE = ["timely_response_status", "company_response", "issue_pattern_status", "issue_volume_current",
            "baseline_volume", "volume_change_pct", "observed_share_pct", "data_completeness_status",
            "recent_publication_lag_flag"]


@register("queue_evidence", lambda: orders_sql(
    "SELECT complaint_id, " + ", ".join(r6(c) if c in TREND_DOUBLES else c for c in EVIDENCE) + " FROM queue"),
    ids="DEC-09 FN-14")
def q_evidence(spark, sf):
    q = Pipeline.orders(spark, sf).queue
    return q.select("complaint_id", *[round6(F.col("evidence_fields")[c]).alias(c) if c in TREND_DOUBLES
                                      else F.col("evidence_fields")[c].alias(c) for c in EVIDENCE])


@register("taxonomy", lambda: orders_sql("SELECT * FROM dim"), ids="AG-05 SET-03 FN-15")
def q_taxonomy(spark, sf):
    return Pipeline.orders(spark, sf).dim


FACT_OUT = [c for c in conform.FACT_COLUMNS
            if c not in ("generated_at", "source_system", "source_url", "source_retrieved_at", "load_run_id")]


@register("fact", lambda: orders_sql(f"SELECT {', '.join(FACT_OUT)} FROM fct"), ids="PRJ-09 JN-04")
def q_fact(spark, sf):
    return Pipeline.orders(spark, sf).fct.select(*FACT_OUT)


@register("taxonomy_join", lambda: orders_sql(
    "SELECT complaint_id, issue_taxonomy_key FROM fct"), ids="JN-04 FN-16")
def q_taxonomy_join(spark, sf):
    pl = Pipeline.orders(spark, sf)
    return pl.records_with_taxonomy().select("complaint_id", "issue_taxonomy_key")


OPS_SQL = """
SELECT metric_date, product AS dashboard_dimension, 'complaint_volume' AS metric_name,
       daily_complaint_count AS metric_value FROM fdm
UNION ALL
SELECT metric_date, product, 'emerging_issue_count', count(*) FROM fdm
WHERE issue_pattern_status = 'QUALIFIED_SIGNAL' GROUP BY 1, 2
UNION ALL
SELECT source_snapshot_date, recommended_action, 'action_count', count(*) FROM queue GROUP BY 1, 2
"""


@register("ops_metrics", lambda: orders_sql(OPS_SQL), ids="SET-02 AG-06 AG-07 PRJ-10")
def q_ops(spark, sf):
    return Pipeline.orders(spark, sf).ops.drop("generated_at")


CASE_OUT = [c for c in marts.CASE_COLUMNS if c != "generated_at"] + ["context_summary"]


def _case_sql(table: str) -> str:
    cols = [r6(c) if c in TREND_DOUBLES else j(c, c) if c in ("reason_codes", "policy_ids") else c
            for c in CASE_OUT if table == "cases" or c != "context_summary"]
    return orders_sql("SELECT " + ", ".join(cols) + f" FROM {table}")


def _case_out(df, with_summary=True):
    cols = [c for c in CASE_OUT if with_summary or c != "context_summary"]
    return df.select(*[round6(c).alias(c) if c in TREND_DOUBLES
                       else F.array_join(c, "|").alias(c) if c in ("reason_codes", "policy_ids")
                       else F.col(c) for c in cols])


@register("agent_context", lambda: _case_sql("cases"), ids="DEC-12 DEC-13 FN-10 FN-11 FN-12")
def q_cases(spark, sf):
    return _case_out(Pipeline.orders(spark, sf).cases)


def bucketed_marts(pl, buckets: int | None = None, tables: list[str] | None = None) -> dict:
    """Fact, signals and queue bucketed by record id, all from one record pass.
    `tables` gets the names of their catalog entries."""
    n = buckets or int(pl.spark.conf.get("spark.sql.shuffle.partitions"))
    key = "complaint_id"
    decided = layout.write_bucketed(pl.wide, key, n, "decided", tables=tables)
    parts = {"fct": marts.fact(decided), "signals": marts.signals(decided), "queue": policy.action_queue(decided, pl.p)}
    return {name: layout.write_bucketed(df, key, n, name, placed=True, tables=tables) for name, df in parts.items()}


@register("case_join", lambda: _case_sql("cases0"), ids="JN-06")
def q_case_join(spark, sf):
    """The three marts joined on the record id where they lie: no exchange, no sort."""
    tables: list[str] = []
    m = bucketed_marts(Pipeline.orders(spark, sf), tables=tables)
    joined = _case_out(marts.case_join(m["fct"], m["signals"], m["queue"]), with_summary=False)
    layout.drop_bucketed(spark, tables)
    return joined


@register("queue_via_rollup_join", _queue_sql, ids="JN-05 AG-04 (reference shape)")
def q_queue_via_join(spark, sf):
    pl = Pipeline.orders(spark, sf)
    q = policy.action_queue(policy.decide_via_join(pl.joined), pl.p)
    return q.select(*[F.array_join(c, "|").alias(c) if c in ("reason_codes", "policy_ids") else F.col(c)
                      for c in QUEUE_OUT])


OPS_AGG_SQL = """
SELECT metric_date, product AS dashboard_dimension, 'complaint_volume' AS metric_name,
       CAST(sum(daily_complaint_count) AS bigint) AS metric_value FROM fdm GROUP BY 1, 2
UNION ALL
SELECT metric_date, product, 'emerging_issue_count', count(*) FROM fdm
WHERE issue_pattern_status = 'QUALIFIED_SIGNAL' GROUP BY 1, 2
UNION ALL
SELECT source_snapshot_date, recommended_action, 'action_count', count(*) FROM queue GROUP BY 1, 2
"""


@register("ops_metrics_aggregated", lambda: orders_sql(OPS_AGG_SQL), ids="SET-02 AG-06 AG-07 (F7 one row per grain)")
def q_ops_agg(spark, sf):
    pl = Pipeline.orders(spark, sf)
    return marts.ops_metrics_aggregated(pl.fdm, pl.queue).drop("generated_at")


@register("signals_salted_join", lambda: orders_sql(
    "SELECT " + ", ".join(r6(c) if c in TREND_DOUBLES else c for c in SIG_OUT) + " FROM signals"),
    ids="JN-03 (salted sort-merge join)")
def q_signals_salted(spark, sf):
    """The record x trend join as a salted sort-merge join."""
    pl = Pipeline.orders(spark, sf)
    s = marts.attach_trend(pl.records, pl.trends, salt_buckets=16)
    return s.select(*[round6(c).alias(c) if c in TREND_DOUBLES else F.col(c) for c in SIG_OUT])


def _events_queue_sql():
    cols = [j(c, c) if c in ("reason_codes", "policy_ids") else c for c in QUEUE_OUT]
    return events_sql("SELECT " + ", ".join(cols) + " FROM queue")


@register("events_action_queue", _events_queue_sql, ids="DEC-04..DEC-11 (dense fixture)")
def q_events_queue(spark, sf):
    q = Pipeline.events(spark, sf).queue
    return q.select(*[F.array_join(c, "|").alias(c) if c in ("reason_codes", "policy_ids") else F.col(c)
                      for c in QUEUE_OUT])
