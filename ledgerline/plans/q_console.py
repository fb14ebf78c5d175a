"""Operations-console queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import json_string_array, round6
from ledgerline.operators import console as co
from ledgerline.operators import exhibits as ex
from ledgerline.params import ORDERS_PARAMS as P
from ledgerline.plans.oracle import orders_sql
from ledgerline.plans.pipeline import ArchivePipeline
from ledgerline.plans.q_archive import FAMILY, SELECTED
from ledgerline.plans.q_core import CASE_OUT, _case_out, j, r6
from ledgerline.plans.q_exhibits import ASOF, COMPLETE_MONTHS_SQL, CURRENT_WINDOW_WHERE
from ledgerline.plans.registry import register
from ledgerline.session import scratch_path
from ledgerline.sources.store import Store

PRODUCT, ISSUE = "BUILDING", "1-URGENT"
DAYS = 180
CASE_ID = "7"


def pl(spark, sf):
    return ArchivePipeline.orders(spark, sf)


@register("provenance", lambda: orders_sql(
    "SELECT CAST(NULL AS varchar) AS source_system, CAST(NULL AS varchar) AS source_url, "
    "CAST(NULL AS timestamp) AS source_retrieved_at, source_snapshot_date, count(*) AS record_count "
    "FROM fct GROUP BY 1, 2, 3, 4"), ids="AG-28")
def q_provenance(spark, sf):
    return co.provenance(pl(spark, sf).fct)


QS_SQL = ("SELECT priority, signal_confidence, recommended_action, policy_version, model_version, count(*) AS cnt "
          "FROM queue GROUP BY 1, 2, 3, 4, 5")


@register("queue_summary", lambda: orders_sql(QS_SQL), ids="AG-29")
def q_queue_summary(spark, sf):
    return co.queue_summary(pl(spark, sf).queue)


def _pct_sql(col: str) -> str:
    return orders_sql(
        f", qs AS ({QS_SQL}), per AS (SELECT {col}, CAST(sum(cnt) AS bigint) AS cnt FROM qs GROUP BY 1) "
        f"SELECT {col}, cnt, CAST(round(CAST(cnt * 100.0 / (SELECT sum(cnt) FROM per) AS decimal(38,12)), 1) "
        f"AS double) AS pct FROM per")


for _col, _name in [("priority", "priority_pct"), ("signal_confidence", "confidence_pct"),
                    ("recommended_action", "action_pct")]:
    register(_name, (lambda c=_col: _pct_sql(c)), ids="AG-30")(
        (lambda c: (lambda spark, sf: co.with_pct(co.queue_summary(pl(spark, sf).queue), c)))(_col))


def _pivot_sql(row: str, col: str) -> str:
    cols = ", ".join(f"CAST(coalesce(sum(CASE WHEN {col} = '{v}' THEN cnt END), 0) AS bigint) AS \"{v}\""
                     for v in fixed.ACCEPTED_VALUES[col])
    return orders_sql(f", qs AS ({QS_SQL}) SELECT {row}, {cols} FROM qs GROUP BY 1")


@register("pivot_priority_confidence", lambda: _pivot_sql("priority", "signal_confidence"), ids="AG-31")
def q_pivot_pc(spark, sf):
    return co.pivot_counts(co.queue_summary(pl(spark, sf).queue), "priority", "signal_confidence")


@register("reason_distribution", lambda: orders_sql(
    ", per AS (SELECT reason_code, count(*) AS cnt FROM (SELECT unnest(reason_codes) AS reason_code FROM queue) x "
    "GROUP BY 1) SELECT reason_code, cnt, CAST(round(CAST(cnt * 100.0 / (SELECT sum(cnt) FROM per) "
    "AS decimal(38,12)), 1) AS double) AS pct FROM per"), ids="AG-32 JN-11")
def q_reasons(spark, sf):
    return co.reason_distribution(pl(spark, sf).queue)


LAST_N = f"metric_date >= {ASOF} - INTERVAL {DAYS} DAY"


@register("trend_volume_by_date", lambda: orders_sql(
    f"SELECT metric_date, CAST(sum(daily_complaint_count) AS bigint) AS volume FROM fdm WHERE {LAST_N} GROUP BY 1"),
    ids="AG-33 PRJ-18")
def q_trend_volume(spark, sf):
    return co.trend_volume_by_date(pl(spark, sf).fdm, DAYS, P.as_of)


@register("trend_top_products", lambda: orders_sql(
    f"SELECT product, CAST(sum(daily_complaint_count) AS bigint) AS volume FROM fdm WHERE {LAST_N} "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"), ids="AG-33")
def q_trend_products(spark, sf):
    return co.trend_top_products(pl(spark, sf).fdm, DAYS, P.as_of)


@register("trend_top_qualified", lambda: orders_sql(
    f"SELECT product, issue, CAST(sum(daily_complaint_count) AS bigint) AS volume FROM fdm WHERE {LAST_N} "
    "AND issue_pattern_status = 'QUALIFIED_SIGNAL' GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"), ids="AG-33")
def q_trend_qualified(spark, sf):
    return co.trend_top_qualified(pl(spark, sf).fdm, DAYS, P.as_of)


@register("queue_detail", lambda: orders_sql(
    "SELECT priority, recommended_action, signal_confidence, array_to_string(reason_codes, ', ') AS reasons, "
    f"count(*) AS cnt FROM queue q JOIN fct f ON q.complaint_id = f.complaint_id WHERE f.product = '{PRODUCT}' "
    f"AND f.issue = '{ISSUE}' GROUP BY 1, 2, 3, 4 ORDER BY cnt DESC, 1, 2, 3, 4 LIMIT 10"), ids="AG-34 JN-12")
def q_queue_detail(spark, sf):
    return co.queue_detail(pl(spark, sf).wide, PRODUCT, ISSUE)


OPS = COMPLETE_MONTHS_SQL.split("SELECT * FROM ops")[0]


@register("metric_dims_by_total", lambda: orders_sql(
    OPS + ", agg AS (SELECT metric_name, dashboard_dimension, CAST(sum(metric_value) AS bigint) AS total FROM ops "
    "GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY total DESC, dashboard_dimension) "
    "AS dimension_rank FROM agg"), ids="AG-36")
def q_dims_by_total(spark, sf):
    return co.dims_by_total(pl(spark, sf).ops).withColumn("dimension_rank", F.col("dimension_rank").cast("bigint"))


BUNDLE_SQL = OPS + """
, sm AS (SELECT * FROM ops WHERE metric_name IN
          (SELECT metric_name FROM ops GROUP BY 1 HAVING count(DISTINCT metric_date) >= 2))
, vals AS (SELECT metric_name, metric_date, dashboard_dimension, sum(metric_value) AS v FROM sm GROUP BY 1, 2, 3)
, dates AS (SELECT DISTINCT metric_name, metric_date FROM sm)
, dims AS (SELECT metric_name, dashboard_dimension,
             row_number() OVER (PARTITION BY metric_name ORDER BY sum(metric_value) DESC, dashboard_dimension)
               AS dimension_rank
           FROM sm GROUP BY 1, 2)
SELECT d.metric_name, d.metric_date, m.dashboard_dimension, m.dimension_rank,
       CAST(coalesce(v.v, 0) AS bigint) AS value
FROM dates d JOIN dims m ON d.metric_name = m.metric_name
LEFT JOIN vals v ON v.metric_name = d.metric_name AND v.metric_date = d.metric_date
                AND v.dashboard_dimension = m.dashboard_dimension
"""


@register("metric_bundle", lambda: orders_sql(BUNDLE_SQL), ids="AG-37 PRJ-20 FN-26")
def q_bundle(spark, sf):
    return co.metric_bundle(pl(spark, sf).ops).withColumn("dimension_rank", F.col("dimension_rank").cast("bigint"))


@register("metric_totals", lambda: orders_sql(
    OPS + ", sm AS (SELECT * FROM ops WHERE metric_name IN (SELECT metric_name FROM ops GROUP BY 1 "
    "HAVING count(DISTINCT metric_date) >= 2)) SELECT metric_name, metric_date, CAST(sum(metric_value) AS bigint) "
    "AS total FROM sm GROUP BY 1, 2"), ids="AG-37 (totals) PRJ-20")
def q_metric_totals(spark, sf):
    return co.metric_totals(pl(spark, sf).ops)


@register("taxonomy_count", lambda: orders_sql("SELECT count(*) AS cnt FROM dim"), ids="AG-40")
def q_tax_count(spark, sf):
    return co.taxonomy_count(pl(spark, sf).dim)


@register("taxonomy_products", lambda: orders_sql("SELECT DISTINCT product FROM dim"), ids="AG-40 SET-03")
def q_tax_products(spark, sf):
    return co.taxonomy_products(pl(spark, sf).dim)


@register("taxonomy_issues", lambda: orders_sql(f"SELECT DISTINCT issue FROM dim WHERE product = '{PRODUCT}'"),
          ids="AG-40")
def q_tax_issues(spark, sf):
    return co.taxonomy_issues(pl(spark, sf).dim, PRODUCT)


HIST_COLS = ["metric_date", "issue_volume_current", "baseline_volume", "volume_change_pct",
             "observed_share_pct", "issue_pattern_status"]
DOUBLES = ("baseline_volume", "volume_change_pct", "observed_share_pct")


def _hist_sql(latest: bool) -> str:
    cols = ", ".join(r6(c) if c in DOUBLES else c for c in HIST_COLS)
    tail = " ORDER BY metric_date DESC LIMIT 1" if latest else ""
    return orders_sql(f"SELECT {cols} FROM fdm WHERE product = '{PRODUCT}' AND issue = '{ISSUE}'{tail}")


def _hist_out(df):
    return df.select(*[round6(c).alias(c) if c in DOUBLES else F.col(c) for c in HIST_COLS])


@register("issue_history", lambda: _hist_sql(False), ids="PRJ-19")
def q_history(spark, sf):
    return _hist_out(co.issue_history(pl(spark, sf).fdm, PRODUCT, ISSUE))


@register("issue_history_latest", lambda: _hist_sql(True), ids="PRJ-19 (latest)")
def q_history_latest(spark, sf):
    return _hist_out(co.latest_of(co.issue_history(pl(spark, sf).fdm, PRODUCT, ISSUE)))


def _reason_sql() -> str:
    from ledgerline.functions.columns import NEXT_STEP, NO_REASON_TEXT, REASON_TEXT
    rmap = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in REASON_TEXT.items()) + "}"
    nmap = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in NEXT_STEP.items()) + "}"
    texts = f"list_filter(list_transform(coalesce(reason_codes, []), lambda x: {rmap}[x]), lambda t: t IS NOT NULL)"
    title = ("list_aggregate(list_transform(string_split(lower(recommended_action), '_'), "
             "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), 'string_agg', ' ')")
    return (f"{title} AS action_label, coalesce({nmap}[recommended_action], {title}) AS next_step, "
            f"CASE WHEN len({texts}) = 0 THEN '{NO_REASON_TEXT}' ELSE array_to_string({texts}, ' ') END "
            "AS reason_text")


SAMPLE_WHERE = (f"(SELECT *, row_number() OVER (PARTITION BY priority, recommended_action ORDER BY "
                f"complaint_received_date DESC, complaint_id) AS rn FROM cases WHERE {CURRENT_WINDOW_WHERE}) s "
                f"WHERE rn <= {P.per_group}")


@register("sample_index", lambda: orders_sql(
    "SELECT complaint_id, product, issue, priority, recommended_action, signal_confidence, "
    + j("policy_ids", "policy_ids") + ", " + _reason_sql() + " FROM " + SAMPLE_WHERE),
    ids="PRJ-15 FN-23 FN-24")
def q_sample_index(spark, sf):
    p = pl(spark, sf)
    s = co.sample_index(ex.stratified_sample(p.cases, P.as_of, P.case_window_days, P.lag_days, P.per_group))
    return s.withColumn("policy_ids", F.array_join("policy_ids", "|"))


@register("case_by_id", lambda: orders_sql(
    "SELECT " + ", ".join(r6(c) if c in DOUBLES else j(c, c) if c in ("reason_codes", "policy_ids") else c
                          for c in CASE_OUT) + f" FROM cases WHERE complaint_id = '{CASE_ID}'"), ids="PRJ-16")
def q_case_by_id(spark, sf):
    """One case from the published mart, laid out by id."""
    from ledgerline.sources import layout
    store = Store(spark, scratch_path(spark, "cases"))
    cases, ranges = layout.write_ranged(store, pl(spark, sf).cases, "complaint_id")
    version = store.publish({"cases": cases, "cases" + layout.RANGES: ranges})
    return _case_out(co.case_by_id(layout.lookup(store, "cases", "complaint_id", CASE_ID, version), CASE_ID))


def _sel() -> str:
    return "[" + ", ".join(f"'{x}'" for x in SELECTED) + "]"


def _members() -> list[str]:
    return [m for fid, _, ms in fixed.FIXTURE_FAMILIES if fid == FAMILY for m in ms]


@register("cases_matching", lambda: orders_sql(
    "SELECT complaint_id, product, " + j("policy_ids", "policy_ids") + " FROM cases WHERE "
    f"coalesce(list_has_any(policy_ids, {_sel()}), false) AND product IN ("
    + ", ".join(f"'{m}'" for m in _members()) + ")"), ids="PRJ-17")
def q_cases_matching(spark, sf):
    c = co.cases_matching(pl(spark, sf).cases, SELECTED, _members())
    return c.select("complaint_id", "product", F.array_join("policy_ids", "|").alias("policy_ids"))


@register("policy_ids_json_roundtrip", lambda: orders_sql(
    "SELECT complaint_id, array_to_string(coalesce(from_json(CAST(to_json(policy_ids) AS varchar), '[\"VARCHAR\"]'), "
    "[]), '|') AS policy_ids FROM cases"), ids="FN-21")
def q_json_roundtrip(spark, sf):
    c = pl(spark, sf).cases
    return c.select("complaint_id", F.array_join(json_string_array(F.to_json("policy_ids")), "|").alias("policy_ids"))
