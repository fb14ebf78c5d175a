"""Data-quality queries: contracts, singular tests, profiles, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import round6
from ledgerline.operators import quality as dq
from ledgerline.params import ORDERS_PARAMS as P
from ledgerline.plans.oracle import orders_sql
from ledgerline.plans.pipeline import ArchivePipeline
from ledgerline.plans.q_core import r6
from ledgerline.plans.q_exhibits import ASOF
from ledgerline.plans.registry import register
from ledgerline.plans.seeded import EVIDENCE, both, both_sql

FCT_CHECK_COLS = ["complaint_id", "complaint_received_date", "cfpb_routing_date", "issue_taxonomy_key", "product",
                  "sub_product", "issue", "sub_issue", "company", "state", "submitted_via", "company_response",
                  "timely_response_status", "company_public_response", "has_narrative",
                  "recent_publication_lag_flag", "data_completeness_status", "source_snapshot_date"]
EXPECTED_ARCHIVE_START = "2011-12-01"


def pl(spark, sf):
    return ArchivePipeline.orders(spark, sf)


def _nulls_sql(table: str, cols: list[str], where: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count FROM {table}"
                              for c in cols) if not where else \
        f"SELECT * FROM ({_nulls_sql(table, cols)}) x WHERE {where}"


@register("dq_null_counts", lambda: orders_sql(_nulls_sql("fct", FCT_CHECK_COLS)), ids="DQ-A (profile)")
def q_null_counts(spark, sf):
    return dq.null_counts(pl(spark, sf).fct, FCT_CHECK_COLS)


@register("dq_not_null_failures", lambda: orders_sql(_nulls_sql("fct", FCT_CHECK_COLS, "null_count > 0")),
          ids="DQ-A")
def q_not_null(spark, sf):
    return dq.not_null(pl(spark, sf).fct, FCT_CHECK_COLS)


# (table, key)
UNIQUE_KEYS = [("raw_cases", "complaint_id"), ("stg", "complaint_id"), ("ctx", "complaint_id"), ("signals", "complaint_id"),
               ("cases", "complaint_id"), ("dim", "issue_taxonomy_key"), ("fct", "complaint_id"), ("queue", "recommendation_id")]


def _unique_sql(x: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, {k} AS key_value, count(*) AS n FROM {t}{x} WHERE {k} IS NOT NULL GROUP BY {k} "
                              "HAVING n > 1" for t, k in UNIQUE_KEYS)


@register("dq_unique_violations", lambda: orders_sql(both_sql(_unique_sql)), ids="DQ-B SET-06")
def q_unique(spark, sf):
    return both(pl(spark, sf), lambda f: dq.unique_all([(t, getattr(f, t), k) for t, k in UNIQUE_KEYS]))


# Table, column, severity and domain of every closed domain.
CONFIDENCES, PRIORITIES = ["HIGH", "MEDIUM", "LIMITED", "NOT_SUPPORTED"], ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
COMPLETENESS, TIMELY = ["COMPLETE", "PARTIAL", "INSUFFICIENT"], ["YES", "NO", "UNKNOWN"]
STATUSES = ["QUALIFIED_SIGNAL", "UNQUALIFIED_SIGNAL", "INSUFFICIENT_BASELINE", "NO_SIGNAL"]
APPLIED = ["STANDARD_HANDLING", "ESCALATE_REVIEW", "INVESTIGATE_PATTERN", "REQUIRE_HUMAN_REVIEW"]
RESPONSES = ["Closed with explanation", "Closed with non-monetary relief", "Closed with monetary relief", "In progress",
             "Untimely response", "Closed", "Closed with relief", "Closed without relief"]
CHANNELS = ["Web", "Referral", "Phone", "Postal mail", "Fax", "Email"]
POLICY_NAMES = ["POLICY_UNTIMELY_RESPONSE", "POLICY_EMERGING_ISSUE", "POLICY_PUBLICATION_LAG", "POLICY_INCOMPLETE_CONTEXT",
                "POLICY_STABLE_PATTERN", "POLICY_CRITICAL_COMBINATION"]
DOMAINS = [
    ("stg", "timely_response_status", "warn", TIMELY), ("ctx", "data_completeness_status", "error", COMPLETENESS),
    ("trends", "issue_pattern_status", "error", STATUSES), ("patterns", "signal_confidence", "error", ["LIMITED"]),
    ("policies", "policy_id", "error", POLICY_NAMES), ("policies", "priority", "error", PRIORITIES),
    ("policies", "recommended_action", "error", APPLIED), ("policies", "signal_confidence", "error", CONFIDENCES[:3]),
    ("signals", "data_completeness_status", "error", COMPLETENESS), ("signals", "issue_pattern_status", "error", STATUSES),
    ("cases", "signal_confidence", "error", CONFIDENCES), ("fct", "timely_response_status", "warn", TIMELY),
    ("fct", "data_completeness_status", "error", COMPLETENESS), ("fct", "company_response", "warn", RESPONSES),
    ("fct", "submitted_via", "warn", CHANNELS), ("fdm", "issue_pattern_status", "error", STATUSES),
    ("queue", "priority", "error", PRIORITIES),
    ("queue", "recommended_action", "error", APPLIED + ["PRIORITIZE_CASE_REVIEW", "UPDATE_AGENT_GUIDANCE"]),
    ("queue", "signal_confidence", "error", CONFIDENCES)]


def _accepted_sql(x: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS varchar) AS value, count(*) AS n, "
                              f"'{sev}' AS severity FROM {t}{x} WHERE NOT list_contains({values!r}, {c}) GROUP BY {c}" for t, c, sev, values in DOMAINS)


@register("dq_accepted_violations", lambda: orders_sql(both_sql(_accepted_sql)), ids="DQ-C")
def q_accepted(spark, sf):
    tables = dict.fromkeys(t for t, _, _, _ in DOMAINS)

    def check(f):
        parts = [dq.accepted_all(getattr(f, t), [(c, sev, v) for u, c, sev, v in DOMAINS if u == t]).select(F.lit(t).alias("table_name"), "*")
                 for t in tables]
        return dq.stacked(parts)

    return both(pl(spark, sf), check)


# Required columns by table.
REQUIRED = {
    "raw_cases": ["complaint_id", "date_received", "product", "issue", "company", "submitted_via", "company_response_to_consumer", "timely_response"],
    "stg": ["complaint_id", "complaint_received_date", "recent_publication_lag_flag"],
    "ctx": ["complaint_id", "complaint_received_date", "product", "issue"],
    "vol": ["metric_date", "product", "issue", "complaint_count"],
    "trends": ["metric_date", "product", "issue", "daily_complaint_count"],
    "patterns": ["metric_date", "company", "product", "issue", "complaint_count"],
    "policies": ["complaint_id", "triggered", "human_review_required"],
    "signals": ["complaint_id"],
    "cases": ["complaint_id", "context_summary"],
    "dim": ["issue_taxonomy_key", "product", "issue"],
    "fct": ["complaint_id", "complaint_received_date", "product", "issue"],
    "fdm": ["metric_date", "product", "issue", "daily_complaint_count"],
    "queue": ["recommendation_id", "complaint_id", "priority", "recommended_action", "signal_confidence", "model_version", "policy_version"],
    "ops": ["metric_date", "metric_name"],
}


def _required_sql(x: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM {t}{x}"
                              for t, cols in REQUIRED.items() for c in cols)


@register("dq_required_columns", lambda: orders_sql(both_sql(_required_sql)), ids="DQ-A (every table, one pass each)")
def q_required(spark, sf):
    return both(pl(spark, sf), lambda f: dq.stacked(
        [dq.null_counts(getattr(f, t), cols).select(F.lit(t).alias("table_name"), "*") for t, cols in REQUIRED.items()]))


def _orphans_sql(x: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS child, c.complaint_id FROM {t}{x} c ANTI JOIN fct p ON p.complaint_id = c.complaint_id "
                              "WHERE c.complaint_id IS NOT NULL" for t in ("queue", "cases"))


@register("dq_relationship_orphans", lambda: orders_sql(both_sql(_orphans_sql)), ids="DQ-D JN-14")
def q_relationships(spark, sf):
    p = pl(spark, sf)
    return both(p, lambda f: dq.stacked([
        dq.relationships(getattr(f, t).filter("complaint_id IS NOT NULL"), p.fct, "complaint_id").select(F.lit(t).alias("child"), "complaint_id")
        for t in ("queue", "cases")]))


COMBINATIONS = [("vol", ["metric_date", "product", "issue"]), ("trends", ["metric_date", "product", "issue"]),
                ("patterns", ["metric_date", "company", "product", "issue"]), ("policies", ["complaint_id", "policy_id"])]


def _combinations_sql(x: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}{x} GROUP BY {', '.join(k)} HAVING n > 1" for t, k in COMBINATIONS)


@register("dq_unique_combination_violations", lambda: orders_sql(both_sql(_combinations_sql)), ids="DQ-E")
def q_unique_combo(spark, sf):
    return both(pl(spark, sf), lambda f: dq.stacked(
        [dq.unique_combo(getattr(f, t), keys).select(F.lit(t).alias("table_name"), "n") for t, keys in COMBINATIONS]))


# Both counts as rows of one list, added up side by side.
RECONCILE_SQL = """
, compared AS (
  SELECT product, issue, CAST(sum(rolled) AS bigint) AS summed_daily_count, CAST(sum(single) AS bigint) AS actual_complaint_count
  FROM (SELECT product, issue, daily_complaint_count AS rolled, NULL AS single FROM fdm
        UNION ALL SELECT product, issue, NULL, 1 FROM ctx) GROUP BY ALL)
"""


@register("reconcile_rollups", lambda: orders_sql(RECONCILE_SQL + "SELECT * FROM compared"), ids="AG-35 JN-07")
def q_reconcile(spark, sf):
    p = pl(spark, sf)
    return dq.reconcile_rollups(p.fdm, p.records)


def _reconciles_sql(x: str) -> str:
    return (f"SELECT product, issue, CAST(sum(rolled) AS bigint) AS summed_daily_count, CAST(sum(single) AS bigint) AS actual_complaint_count FROM ("
            f"SELECT product, issue, daily_complaint_count AS rolled, NULL AS single FROM fdm_counts{x} UNION ALL "
            "SELECT product, issue, NULL, 1 FROM ctx) GROUP BY ALL HAVING summed_daily_count IS DISTINCT FROM actual_complaint_count")


@register("dq_daily_reconciles", lambda: orders_sql(both_sql(_reconciles_sql)), ids="DQ-F FN-16")
def q_daily_reconciles(spark, sf):
    return both(pl(spark, sf), lambda f: dq.daily_reconciles(f.fdm_counts, f.records))


DROPPED_SQL = "SELECT (SELECT count(*) FROM raw_cases) - (SELECT count(*) FROM stg) AS dropped_row_count"


@register("dropped_row_count", lambda: orders_sql(DROPPED_SQL), ids="JN-08")
def q_dropped(spark, sf):
    p = pl(spark, sf)
    return dq.dropped_rows(p.raw, p.staged)


@register("dq_dropped_bounded", lambda: orders_sql(both_sql(
    lambda x: f"SELECT (SELECT count(*) FROM raw_cases) - (SELECT count(*) FROM stg_rows{x}) AS dropped_row_count "
              "WHERE dropped_row_count NOT BETWEEN 0 AND 100")), ids="DQ-G")
def q_dropped_bounded(spark, sf):
    return both(pl(spark, sf), lambda f: dq.dropped_bounded(f.raw, f.stg_rows))


@register("dq_critical_without_trigger", lambda: orders_sql(both_sql(
    lambda x: f"SELECT complaint_id, priority FROM queue{x} WHERE priority = 'CRITICAL' AND NOT (list_contains(policy_ids, "
              "'POLICY_CRITICAL_COMBINATION') AND data_completeness_status = 'COMPLETE' AND NOT recent_publication_lag_flag)")), ids="DQ-H FN-13")
def q_critical(spark, sf):
    return both(pl(spark, sf), lambda f: dq.critical_without_trigger(f.queue).select("complaint_id", "priority"))


def _reasons_sql(x: str) -> str:
    evidence = ", ".join(c for c in EVIDENCE if c != "recent_publication_lag_flag")
    return (f"SELECT complaint_id, recommended_action FROM queue{x} WHERE recommended_action <> 'STANDARD_HANDLING' AND (ifnull(len(reason_codes), 0) = 0 "
            f"OR ifnull(len(policy_ids), 0) = 0 OR signal_confidence IS NULL OR coalesce({', '.join(f'CAST({c} AS varchar)' for c in evidence.split(', '))}) IS NULL)")


@register("dq_reason_required", lambda: orders_sql(both_sql(_reasons_sql)), ids="DQ-I")
def q_reason_required(spark, sf):
    return both(pl(spark, sf), lambda f: dq.reason_required(f.queue).select("complaint_id", "recommended_action"))


@register("dq_duration_columns", lambda: orders_sql(
    "SELECT 'fct' AS table_name, unnest(['avg_response_days', 'Elapsed_Time']) AS column_name, (SELECT count(*) FROM fct) AS records"),
    ids="DQ-J FN-17")
def q_duration(spark, sf):
    """The marts, and the fact table with two columns that claim a duration: only those two are found."""
    p = pl(spark, sf)
    claimed = p.fct.withColumn("avg_response_days", F.lit(1)).withColumn("Elapsed_Time", F.lit(1))
    found = dq.duration_columns(spark, {"fct": claimed, "queue": p.queue, "cases": p.cases, "fdm": p.fdm, "ops": p.ops, "dim": p.dim})
    return found.withColumn("records", p.fct.agg(F.count(F.lit(1))).scalar())


@register("dq_results", lambda: orders_sql(
    RECONCILE_SQL + f"""
SELECT 'daily_volume_reconciles' AS check_name, 'error' AS severity, count(*) AS failures,
  CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END AS status
FROM compared WHERE summed_daily_count IS DISTINCT FROM actual_complaint_count
UNION ALL
SELECT 'dropped_row_count_bounded', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END
FROM ({DROPPED_SQL}) x WHERE dropped_row_count > 100 OR dropped_row_count < 0
UNION ALL
SELECT 'not_null_sub_product', 'warn', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END
FROM fct WHERE sub_product IS NULL
UNION ALL
SELECT 'unique_complaint_id', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END
FROM (SELECT complaint_id FROM fct WHERE complaint_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u"""),
    ids="DQ-K")
def q_results(spark, sf):
    from ledgerline.plans.q_sources import _scratch
    p = pl(spark, sf)
    return dq.run_checks([
        ("daily_volume_reconciles", "error", dq.daily_reconciles(p.fdm, p.records)),
        ("dropped_row_count_bounded", "error", dq.dropped_bounded(p.raw, p.staged)),
        ("not_null_sub_product", "warn", p.fct.filter(F.col("sub_product").isNull())),
        ("unique_complaint_id", "error", dq.unique(p.fct, "complaint_id")),
    ], store_root=_scratch(spark, "dq-failures"))


@register("dq_freshness", lambda: orders_sql(
    f"SELECT max(source_snapshot_date) AS latest, datediff('day', max(source_snapshot_date), {ASOF}) AS age_days, "
    f"CASE WHEN max(source_snapshot_date) IS NULL OR datediff('day', max(source_snapshot_date), {ASOF}) > 14 "
    f"THEN 'error' WHEN datediff('day', max(source_snapshot_date), {ASOF}) > 3 THEN 'warn' ELSE 'pass' END AS status "
    "FROM raw_cases"), ids="DQ-L")
def q_freshness(spark, sf):
    df = dq.freshness(pl(spark, sf).raw, P.as_of, col="source_snapshot_date")
    return df.withColumn("age_days", F.col("age_days").cast("bigint"))


@register("dq_freshness_loaded", lambda: orders_sql(
    "SELECT u.as_of, u.status, (SELECT count(*) FROM raw_cases) AS records FROM (VALUES ('same day', 'pass'), ('four days on', 'warn'), "
    "('fifteen days on', 'error')) u(as_of, status)"), ids="DQ-L (loaded_at of a landed run)")
def q_freshness_loaded(spark, sf):
    import datetime as dt
    from ledgerline.plans.q_sources import read_landed
    landed = read_landed(spark, sf)
    records = landed.agg(F.count(F.lit(1))).scalar()
    today = landed.agg(F.max(F.col("loaded_at").cast("date")).alias("d")).first()["d"]
    return dq.stacked([dq.freshness(landed, today + dt.timedelta(days=n)).select(F.lit(name).alias("as_of"), "status", records.alias("records"))
                       for name, n in (("same day", 0), ("four days on", 4), ("fifteen days on", 15))])


def _blank_sql(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def _profile_cte() -> str:
    """`, a AS (one-row aggregate), prof AS (metric rows)`."""
    cols = [n for n, _ in fixed.RAW_COLUMNS]
    nulls = ", ".join(f"count_if({_blank_sql(c)}) AS \"null_count:{c}\"" for c in cols)
    base = (f"SELECT count(*) AS total_rows, count(DISTINCT CASE WHEN NOT {_blank_sql('complaint_id')} "
            f"THEN complaint_id END) AS unique_ids, "
            f"min(CASE WHEN NOT {_blank_sql('date_received')} THEN date_received END) AS date_received_min, "
            f"max(CASE WHEN NOT {_blank_sql('date_received')} THEN date_received END) AS date_received_max, "
            f"{nulls} FROM raw_cases")
    rows = ["SELECT 'total_rows' AS metric, total_rows AS value, NULL::double AS pct FROM a",
            "SELECT 'unique_ids', unique_ids, NULL FROM a",
            "SELECT 'duplicate_ids', total_rows - \"null_count:complaint_id\" - unique_ids, NULL FROM a"]
    rows += [f"SELECT 'null_count:{c}', \"null_count:{c}\", "
             f"CAST(round(CAST(\"null_count:{c}\" * 100.0 / total_rows AS decimal(38,12)), 4) AS double) FROM a"
             for c in cols]
    return (f", a AS ({base}), prof AS (SELECT u.metric, CAST(u.value AS bigint) AS value, u.pct, "
            f"a.date_received_min, a.date_received_max FROM ({' UNION ALL '.join(rows)}) u, a)")


@register("raw_profile", lambda: orders_sql(_profile_cte() + " SELECT * FROM prof"), ids="DQ-M SRC-04")
def q_profile(spark, sf):
    return dq.profile(pl(spark, sf).raw)


@register("raw_profile_by_month", lambda: orders_sql(
    f"SELECT substr(date_received, 1, 7) AS month, count(*) AS complaints, "
    f"count_if(NOT {_blank_sql('consumer_complaint_narrative')}) AS narratives FROM raw_cases GROUP BY 1"),
    ids="DQ-N")
def q_profile_month(spark, sf):
    return dq.profile_by_month(pl(spark, sf).raw)


FLAGS_SQL = """
SELECT zip_masked_count, CAST(round(CAST(zip_masked_count * 100.0 / n AS decimal(38,12)), 4) AS double)
         AS zip_masked_rate_pct,
       in_progress_count, CAST(round(CAST(in_progress_count * 100.0 / n AS decimal(38,12)), 4) AS double)
         AS in_progress_rate_pct
FROM (SELECT count(*) AS n, count_if(coalesce(regexp_matches(zip_code, '[Xx]'), false)) AS zip_masked_count,
             count_if(company_response_to_consumer = 'In progress') AS in_progress_count FROM raw_cases) x
"""


@register("raw_profile_flags", lambda: orders_sql(FLAGS_SQL), ids="DQ-O FN-25")
def q_flags(spark, sf):
    return dq.profile_flags(pl(spark, sf).raw)


def _drift_sql() -> str:
    base = ", ".join(f"('null_count:{k}', {v})" for k, v in dq.NULL_RATE_BASELINE_PCT.items())
    lo, hi = dq.ZIP_MASK_BAND_PCT
    return orders_sql(_profile_cte() + f"""
, flags AS ({FLAGS_SQL})
, base AS (SELECT * FROM (VALUES {base}) t(metric, baseline_pct))
SELECT 'null_rate_drift' AS check_name, replace(prof.metric, 'null_count:', '') AS subject, prof.pct AS observed,
       base.baseline_pct AS expected
FROM prof JOIN base ON prof.metric = base.metric WHERE abs(prof.pct - base.baseline_pct) > {dq.DRIFT_WARN_THRESHOLD_PCT}
UNION ALL
SELECT 'zip_mask_band', 'zip_code', zip_masked_rate_pct, NULL FROM flags
WHERE zip_masked_rate_pct < {lo} OR zip_masked_rate_pct > {hi}
UNION ALL
SELECT 'archive_start', date_received_min, NULL, NULL FROM prof
WHERE metric = 'total_rows' AND date_received_min IS DISTINCT FROM '{EXPECTED_ARCHIVE_START}'
""")


@register("dq_drift_warnings", _drift_sql, ids="DQ-P")
def q_drift(spark, sf):
    p = pl(spark, sf)
    return dq.drift(dq.profile(p.raw), dq.profile_flags(p.raw), EXPECTED_ARCHIVE_START)


@register("dq_blocking", lambda: orders_sql(both_sql(
    lambda x: f"SELECT u.check_name, u.value FROM (SELECT count(complaint_id) - count(DISTINCT complaint_id) AS d, count(*) - count(complaint_id) AS m "
              f"FROM (SELECT nullif(trim(complaint_id), '') AS complaint_id FROM raw_cases{x})) a, LATERAL (SELECT 'duplicate_ids' AS check_name, a.d AS value "
              "UNION ALL SELECT 'null_count:complaint_id', a.m) u WHERE u.value <> 0")), ids="DQ-Q")
def q_blocking(spark, sf):
    return both(pl(spark, sf), lambda f: dq.blocking(dq.profile(f.raw_cases), f.raw_cases.columns))


LAG_SQL = f"""
, b AS (SELECT datediff('day', complaint_received_date, {ASOF}) AS age,
          coalesce(company_response = 'In progress', false) AS ip FROM ctx)
SELECT bucket, total, in_progress, {r6('CASE WHEN total > 0 THEN in_progress / CAST(total AS double) END', 'share')}
FROM (
  SELECT 'last_7_days' AS bucket, count_if(age <= 7) AS total, count_if(age <= 7 AND ip) AS in_progress FROM b
  UNION ALL SELECT 'days_30_60', count_if(age >= 30 AND age <= 60), count_if(age >= 30 AND age <= 60 AND ip) FROM b
  UNION ALL SELECT 'about_12_months_prior', count_if(age >= 365 AND age <= 395),
    count_if(age >= 365 AND age <= 395 AND ip) FROM b
  UNION ALL SELECT 'all', count(*), count_if(ip) FROM b) x
"""


@register("lag_by_recency", lambda: orders_sql(LAG_SQL), ids="DQ-R")
def q_lag(spark, sf):
    return dq.lag_by_recency(pl(spark, sf).records, P.as_of).withColumn("share", round6("share"))


def _shares_sql(col: str) -> str:
    return orders_sql(f", per AS (SELECT {col}, count(*) AS n FROM ctx GROUP BY 1) SELECT {col}, n, "
                      f"{r6('n / CAST((SELECT sum(n) FROM per) AS double)', 'share')} FROM per")


for _c, _n in [("company_response", "response_shares"), ("timely_response_status", "timely_shares"),
               ("submitted_via", "channel_shares")]:
    register(_n, (lambda c=_c: _shares_sql(c)), ids="DQ-S")(
        (lambda c: (lambda spark, sf: dq.domain_shares(pl(spark, sf).records, c)
                    .withColumn("share", round6("share"))))(_c))


@register("product_concentration", lambda: orders_sql(
    f", per AS (SELECT product, count(*) AS n FROM ctx GROUP BY 1) SELECT product, n, "
    f"{r6('n / CAST((SELECT sum(n) FROM per) AS double)', 'share')}, "
    "row_number() OVER (ORDER BY n DESC, product) AS rank FROM per"), ids="DQ-T")
def q_concentration(spark, sf):
    df = dq.concentration(pl(spark, sf).records, "product")
    return df.withColumn("share", round6("share")).withColumn("rank", F.col("rank").cast("bigint"))


@register("dq_unknown_taxonomy", lambda: orders_sql(both_sql(
    lambda x: f"SELECT product, sub_product, issue, sub_issue FROM ctx EXCEPT SELECT product, sub_product, issue, sub_issue FROM dim_rows{x}")), ids="DQ-U")
def q_unknown_taxonomy(spark, sf):
    return both(pl(spark, sf), lambda f: dq.unknown_labels(f.records, f.dim_rows))


def _top_values_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value FROM raw_cases" for f in dq.TOP_VALUE_FIELDS)
    return orders_sql(f"""
, long_ AS (SELECT * FROM ({parts}) u WHERE value IS NOT NULL AND value <> '')
, counts AS (SELECT field, value, count(*) AS n FROM long_ GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rank FROM counts) r
WHERE rank <= 25""")


@register("raw_top_values", _top_values_sql, ids="TK-05")
def q_top_values(spark, sf):
    return dq.top_values(pl(spark, sf).raw).withColumn("rank", F.col("rank").cast("bigint"))
