"""Default parameters on a dense fixture, seeds and their parity, landed lineage, export documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.operators import console as co
from ledgerline.operators import exhibits as ex
from ledgerline.operators import quality as dq
from ledgerline.params import ORDERS_PARAMS as P
from ledgerline.params import Params
from ledgerline.plans.oracle import chain, orders_sql
from ledgerline.plans.pipeline import ArchivePipeline, Pipeline
from ledgerline.plans.q_core import QUEUE_OUT, TREND_SQL, _trend_out, j
from ledgerline.plans.q_exhibits import POLICY_BY_PRODUCT_SQL
from ledgerline.plans.q_sources import RAW_NAMES, RAW_NULLED, RETRIEVED, URL, _scratch, read_landed
from ledgerline.plans.registry import REGISTRY, register
from ledgerline.sources import fixtures, raw as rw, sinks

# The library's defaults (7 / 30 / 20 / 50 / 0.30), on the line items by return flag and ship date.
DENSE = Params(snapshot_date=dt.date(2001, 10, 15), as_of=dt.date(2001, 10, 15))


def dense(spark, sf) -> Pipeline:
    return Pipeline(fixtures.lineitem_raw_cases(spark, sf, DENSE.snapshot_date), DENSE)


@register("default_issue_trends", lambda: chain(DENSE, "lineitem") + TREND_SQL, ids="W-01 W-02 DEC-01 DEC-02 DEC-03 (default parameters)")
def q_default_trends(spark, sf):
    return _trend_out(dense(spark, sf).trends)


@register("default_action_queue", lambda: chain(DENSE, "lineitem") + "SELECT " + ", ".join(
    j(c, c) if c in ("reason_codes", "policy_ids") else c for c in QUEUE_OUT) + " FROM queue", ids="DEC-04..DEC-11 (default parameters)")
def q_default_queue(spark, sf):
    return dense(spark, sf).queue.select(*[F.array_join(c, "|").alias(c) if c in ("reason_codes", "policy_ids") else F.col(c) for c in QUEUE_OUT])


ACTIONS = ["STANDARD_HANDLING", "PRIORITIZE_CASE_REVIEW", "ESCALATE_REVIEW", "INVESTIGATE_PATTERN", "REQUIRE_HUMAN_REVIEW", "UPDATE_AGENT_GUIDANCE"]


@register("pivot_priority_action", lambda: orders_sql("SELECT priority, " + ", ".join(
    f"count(*) FILTER (recommended_action = '{a}') AS \"{a}\"" for a in ACTIONS) + " FROM queue GROUP BY priority"), ids="AG-31 (priority x action)")
def q_pivot_action(spark, sf):
    return co.pivot_counts(co.queue_summary(ArchivePipeline.orders(spark, sf).queue), "priority", "recommended_action")


@register("policy_by_product_joined", lambda: orders_sql(POLICY_BY_PRODUCT_SQL), ids="JN-10 JN-11")
def q_policy_joined(spark, sf):
    """The same counts as an explode of the fired policies joined to the evaluated counts."""
    cases = Pipeline.orders(spark, sf).cases.select("product", "policy_ids")
    fired = cases.select("product", F.explode("policy_ids").alias("policy_id")).groupBy("product", "policy_id").agg(F.count(F.lit(1)).alias("triggered_count"))
    return fired.join(cases.groupBy("product").agg(F.count(F.lit(1)).alias("evaluated_count")), "product")


SEED_SQL = """
SELECT s.*, (SELECT count(*) FROM policies p WHERE p.policy_id = s.policy_id AND p.triggered) AS triggered FROM (VALUES
  ('POLICY_UNTIMELY_RESPONSE', NULL, 0, 0, 0, 0, NULL, NULL, 1, 'HIGH', 'ESCALATE_REVIEW', 'PUBLISHED_UNTIMELY_RESPONSE', 'HIGH', true),
  ('POLICY_EMERGING_ISSUE', 'product_issue', 7, 30, 20, 50, 0.3::DOUBLE, NULL, 1, 'HIGH', 'INVESTIGATE_PATTERN', 'EMERGING_ISSUE_SIGNAL', 'MEDIUM', true),
  ('POLICY_PUBLICATION_LAG', NULL, 0, 0, 0, 0, NULL, 60, 1, 'MEDIUM', 'REQUIRE_HUMAN_REVIEW', 'RECENT_PUBLICATION_LAG', 'LIMITED', true),
  ('POLICY_INCOMPLETE_CONTEXT', NULL, 0, 0, 0, 0, NULL, NULL, 1, 'MEDIUM', 'REQUIRE_HUMAN_REVIEW', 'INCOMPLETE_CONTEXT', 'LIMITED', true),
  ('POLICY_STABLE_PATTERN', NULL, 0, 0, 0, 0, NULL, NULL, 0, 'LOW', 'STANDARD_HANDLING', 'STABLE_PATTERN', 'HIGH', false),
  ('POLICY_CRITICAL_COMBINATION', NULL, 0, 0, 0, 0, NULL, NULL, 2, 'CRITICAL', 'ESCALATE_REVIEW', 'MULTIPLE_QUALIFIED_TRIGGERS', 'LOWEST_OF_CONTRIBUTORS', true)
) s(policy_id, trend_grain, current_window_days, baseline_window_days, min_current_volume, min_baseline_volume, minimum_pct_change,
    publication_lag_window_days, min_triggered_high_policies, priority, action, reason_code, signal_confidence, human_review_required)
"""


@register("policy_threshold_seed", lambda: orders_sql(SEED_SQL), ids="SRC-07 (14 columns, with the records each policy fires on)")
def q_seed(spark, sf):
    fired = Pipeline.orders(spark, sf).evals.groupBy("policy_id").agg(F.count_if("triggered").alias("triggered"))
    return rw.seeds(spark)["priority_policy_thresholds"].join(fired, "policy_id", "left").withColumn("triggered", F.coalesce("triggered", F.lit(0)))


@register("config_parity", lambda: orders_sql("""
SELECT c.run, c.parameter, c.configured, c.seeded, (SELECT count(*) FROM raw_cases) AS records FROM (VALUES
  ('orders fixture', 'baseline_window_days', 120.0::DOUBLE, 30.0::DOUBLE), ('orders fixture', 'current_window_days', 28.0, 7.0),
  ('orders fixture', 'min_baseline_volume', 4.0, 50.0), ('orders fixture', 'min_current_volume', 4.0, 20.0)) c(run, parameter, configured, seeded)"""),
    ids="DQ-V")
def q_parity(spark, sf):
    """Parameters of a run against the audited seed: the defaults agree, the sparse fixture's do not."""
    seed = rw.seeds(spark)["priority_policy_thresholds"]
    found = dq.stacked([dq.parity(seed, p).select(F.lit(run).alias("run"), "*") for run, p in (("defaults", Params()), ("orders fixture", P))])
    return found.withColumn("records", Pipeline.orders(spark, sf).raw.agg(F.count(F.lit(1))).scalar())


LINEAGE_SQL = (f"'CFPB' AS source_system, '{URL}' AS source_url, TIMESTAMP '{RETRIEVED}' AS source_retrieved_at, DATE '{P.snapshot_date}' AS "
               "source_snapshot_date, 'run-1' AS load_run_id")


@register("landed_lineage", lambda: orders_sql(f"SELECT {RAW_NULLED}, {LINEAGE_SQL}, true AS named_csv, true AS loaded_after_retrieval FROM raw_cases"), ids="SRC-02 (all seven values)")
def q_lineage(spark, sf):
    r = rw.accepted_rows(read_landed(spark, sf))
    return r.select(*RAW_NAMES, "source_system", "source_url", "source_retrieved_at", "source_snapshot_date", "load_run_id",
                    F.col("source_file_name").rlike(r"^part-.*\.csv(\.gz)?$").alias("named_csv"),
                    (F.col("loaded_at") > F.col("source_retrieved_at")).alias("loaded_after_retrieval"))


@register("landed_provenance", lambda: orders_sql(f"SELECT {LINEAGE_SQL.rsplit(', ', 1)[0]}, count(*) AS record_count FROM raw_cases"), ids="AG-28 (landed rows)")
def q_landed_provenance(spark, sf):
    return co.provenance(rw.accepted_rows(read_landed(spark, sf)))


# document -> section -> registered query of the same rows (its SQL gives the expected number)
DOCUMENTS = {
    "agent_case_context": {"cases": "current_window_cases"},
    "operations_overview_metrics": {"metrics": "complete_month_metrics"},
    "export_meta": {"meta": "export_meta"},
    "ledger_exhibits": {"totals": "archive_totals", "monthly_volume": "monthly_volume", "products": "top_products", "priority": "priority_distribution",
                        "confidence": "confidence_distribution", "action": "action_distribution", "policy_triggers": "policy_trigger_rates",
                        "completeness": "completeness_distribution", "timely": "timely_distribution", "emerging_signals": "latest_signals",
                        "companies": "top_companies"},
    "archive_explorer": {"monthly_product_volume": "month_product", "product_issue_movement": "issue_movement", "policy_by_product": "policy_by_product",
                         "policy_combinations": "policy_combos", "weekday_rhythm": "weekday_rhythm", "state_by_product": "state_by_product",
                         "response_by_product": "response_by_product", "channel_by_product": "channel_by_product", "company_by_product": "company_outcomes"},
    "month_issue_volume": {"months": "month_product_issue"},
}


def documents(p: ArchivePipeline) -> dict[str, dict]:
    """The six export documents: document -> section -> table."""
    from ledgerline.plans.q_exhibits import SINCE
    as_of, fct, queue, fdm = p.p.as_of, p.fct, p.queue, p.fdm
    cases = sinks.export_cases(ex.current_window(p.cases, as_of, p.p.case_window_days, p.p.lag_days))
    metrics = sinks.export_metrics(ex.complete_months(p.ops, as_of, p.p.case_window_days))
    return {
        "agent_case_context": {"cases": cases}, "operations_overview_metrics": {"metrics": metrics},
        "export_meta": {"meta": sinks.export_meta(cases, metrics, p.raw, "v1", p.p.lag_days, p.p.case_window_days, as_of)},
        "ledger_exhibits": {
            "totals": ex.archive_totals(fct), "monthly_volume": ex.monthly_volume(fdm, as_of, SINCE), "products": ex.top_products(fct),
            "priority": ex.count_by(queue, "priority"), "confidence": ex.count_by(queue, "signal_confidence"),
            "action": ex.count_by(queue, "recommended_action"), "policy_triggers": ex.policy_trigger_rates(p.wide),
            "completeness": ex.count_by(fct, "data_completeness_status"), "timely": ex.count_by(fct, "timely_response_status"),
            "emerging_signals": ex.latest_signals(p.trends, as_of), "companies": ex.top_companies(p.patterns)},
        "archive_explorer": {
            "monthly_product_volume": p.mp, "product_issue_movement": p.mov, "policy_by_product": p.pbp, "policy_combinations": p.combos,
            "weekday_rhythm": ex.weekday_rhythm(fdm, as_of),
            "state_by_product": ex.count_by(fct.filter("state IS NOT NULL AND length(state) = 2"), "product", "state"),
            "response_by_product": ex.count_by(fct.filter("company_response IS NOT NULL"), "product", "company_response"),
            "channel_by_product": ex.count_by(fct.filter("submitted_via IS NOT NULL"), "product", "submitted_via"),
            "company_by_product": ex.company_outcomes(fct)},
        "month_issue_volume": {"months": p.mpi},
    }


def made_once(p: ArchivePipeline) -> ArchivePipeline:
    """The pipeline with its records and what is decided of them written: every section
    reads one of these, and no join behind them is made again."""
    p.raw = sinks.staged(p.raw, "raw")
    p.wide = sinks.staged(p.wide, "decided")
    return p


def _documents_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{d}' AS document, '{s}' AS section, (SELECT count(*) FROM ({REGISTRY[q].sql()})) AS n"
                              for d, sections in DOCUMENTS.items() for s, q in sections.items())


@register("export_documents", _documents_sql, ids="SNK-05 (six documents)")
def q_documents(spark, sf):
    """Write every section as JSON and count what is read back."""
    path, out = _scratch(spark, "documents"), []
    for document, sections in documents(made_once(ArchivePipeline.orders(spark, sf))).items():
        for section, df in sections.items():
            df.write.json(f"{path}/{document}/{section}")
            back = spark.read.schema("line string").text(f"{path}/{document}/{section}")
            out.append(back.agg(F.count(F.lit(1)).alias("n")).select(F.lit(document).alias("document"), F.lit(section).alias("section"), "n"))
    return dq.stacked(out)


@register("calendar_functions", lambda: orders_sql("""
SELECT strftime(metric_date, '%Y-%m') AS month, strftime(min(metric_date) - INTERVAL 12 MONTH, '%Y-%m') AS year_before,
  CAST(max(metric_date) - INTERVAL 60 DAY AS date) AS lag_start, len(range(min(metric_date), max(metric_date) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS axis_days
FROM vol GROUP BY ALL"""), ids="FN-04 FN-22 FN-26")
def q_calendar(spark, sf):
    """Month shift, day offset and date axis over each month of the daily volume."""
    from ledgerline.functions import date_axis, days_before, shift_month
    month = F.date_format("metric_date", "yyyy-MM")
    span = Pipeline.orders(spark, sf).vol.groupBy(month.alias("month")).agg(F.min("metric_date").alias("a"), F.max("metric_date").alias("b"))
    return span.select("month", shift_month("month", -12).alias("year_before"), days_before(F.col("b"), 60).alias("lag_start"),
                       F.size(date_axis("a", "b")).cast("long").alias("axis_days"))
