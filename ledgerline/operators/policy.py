"""Decision operators (DEC-04..DEC-12, AG-04, SET-01).

The six policies are evaluated *inside each record's row*; the per-record
roll-up (ordered policy ids, reasons, weakest confidence, precedence flags)
is built from the four trigger booleans with code-generated expressions.
No union of six scans and no re-aggregation by complaint_id: the
record-level decision is a narrow transformation with zero shuffles.  The
long (record x policy) table is an `array<struct>` of the six evaluations,
expanded with `inline` only when requested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import confidence_label, fmt_fixed, surrogate_key
from ledgerline.params import Params

EVAL_FIELDS = ["policy_id", "triggered", "priority", "recommended_action", "reason_code",
               "signal_confidence", "human_review_required"]


def triggers(df: DataFrame) -> DataFrame:
    """DEC-04: four trigger booleans (three-valued, as in SQL)."""
    return df.withColumns({
        "is_untimely": F.col("timely_response_status") == "NO",
        "is_emerging": F.col("issue_pattern_status") == fixed.QUALIFIED,
        "is_lagged": F.col("recent_publication_lag_flag"),
        "is_incomplete": F.col("data_completeness_status") != "COMPLETE",
    })


def _trigger_expr(policy_id: str) -> Column:
    """DEC-06: STABLE = none of four; CRITICAL = untimely & emerging & clean."""
    u, e, lag, inc = (F.col("is_untimely"), F.col("is_emerging"), F.col("is_lagged"), F.col("is_incomplete"))
    if policy_id == "POLICY_UNTIMELY_RESPONSE":
        return u
    if policy_id == "POLICY_EMERGING_ISSUE":
        return e
    if policy_id == "POLICY_PUBLICATION_LAG":
        return lag
    if policy_id == "POLICY_INCOMPLETE_CONTEXT":
        return inc
    if policy_id == "POLICY_STABLE_PATTERN":
        return ~u & ~e & ~lag & ~inc
    if policy_id == "POLICY_CRITICAL_COMBINATION":
        return u & e & ~lag & ~inc
    raise KeyError(policy_id)


def policy_confidence(pid: str, conf: str, limited_products: tuple[str, ...] = ()) -> Column:
    """A policy's signal confidence; EXT-04 makes the emerging-issue policy
    LIMITED for flagged product categories."""
    if pid == "POLICY_EMERGING_ISSUE" and limited_products:
        return F.when(F.col("product").isin(list(limited_products)), F.lit("LIMITED")).otherwise(F.lit(conf))
    return F.lit(conf)


def with_evaluations(df: DataFrame, limited_products: tuple[str, ...] = ()) -> DataFrame:
    """DEC-05: `evaluations` = array of six policy structs, policy_id first so
    that array_sort orders by policy id."""
    structs = []
    for pid, prio, action, reason, conf, review in fixed.POLICIES:
        structs.append(F.struct(
            F.lit(pid).alias("policy_id"), _trigger_expr(pid).alias("triggered"),
            F.lit(prio).alias("priority"), F.lit(action).alias("recommended_action"),
            F.lit(reason).alias("reason_code"),
            policy_confidence(pid, conf, limited_products).alias("signal_confidence"),
            F.lit(review).alias("human_review_required")))
    return triggers(df).withColumn("evaluations", F.array(*structs))


def evaluate_long(df: DataFrame, limited_products: tuple[str, ...] = ()) -> DataFrame:
    """SET-01 / DEC-05 long form: one row per record x policy."""
    return with_evaluations(df, limited_products).select("complaint_id", F.inline("evaluations"))


def _fired(pid: str) -> Column:
    """Policy fired (a NULL trigger counts as not fired, like `where triggered`)."""
    return F.coalesce(_trigger_expr(pid), F.lit(False))


FIRED = {pid: f"_fired_{i}" for i, pid in enumerate(fixed.POLICY_IDS)}


def _rank_of(pid: str, conf: str, limited_products: tuple[str, ...]) -> Column:
    if pid == "POLICY_EMERGING_ISSUE" and limited_products:
        from ledgerline.functions import confidence_rank
        return confidence_rank(policy_confidence(pid, conf, limited_products))
    return F.lit(fixed.CONFIDENCE_RANK[conf])


def with_rollup(df: DataFrame, limited_products: tuple[str, ...] = ()) -> DataFrame:
    """AG-04 without a shuffle and without lambdas: each policy's fired flag
    is computed once; the triggered policy ids and reasons are conditional
    literals laid out in policy-id order (the order `within group (order by
    policy_id)` gives), NULLs removed with `array_except`; the weakest
    confidence is `least` of the fired ranks.  Every expression is
    code-generated.  A record with nothing triggered gets NULL arrays and
    rank (as a missing roll-up row would)."""
    t = triggers(df).withColumns({FIRED[pid]: _fired(pid) for pid in fixed.POLICY_IDS})
    fired = {pid: F.col(c) for pid, c in FIRED.items()}
    ordered = sorted(fixed.POLICIES, key=lambda p: p[0])
    no_str = F.array(F.lit(None).cast("string"))
    ids = F.array_except(F.array(*[F.when(fired[p[0]], F.lit(p[0])) for p in ordered]), no_str)
    reasons = F.array_except(F.array(*[F.when(fired[p[0]], F.lit(p[3])) for p in ordered]), no_str)
    ranks = [F.when(fired[p[0]], _rank_of(p[0], p[4], limited_products)) for p in ordered]
    none_arr = F.lit(None).cast("array<string>")
    return t.select(
        *[c for c in t.columns if c not in FIRED.values()],
        F.when(F.size(ids) > 0, ids).otherwise(none_arr).alias("triggered_policy_ids"),
        F.when(F.size(reasons) > 0, reasons).otherwise(none_arr).alias("triggered_reason_codes"),
        F.least(*ranks).alias("min_confidence_rank"),
        fired["POLICY_INCOMPLETE_CONTEXT"].alias("incomplete_triggered"),
        fired["POLICY_PUBLICATION_LAG"].alias("lag_triggered"),
        fired["POLICY_CRITICAL_COMBINATION"].alias("critical_triggered"),
        fired["POLICY_UNTIMELY_RESPONSE"].alias("untimely_triggered"),
        fired["POLICY_EMERGING_ISSUE"].alias("emerging_triggered"),
    )


def grouped_rollup(evals_long: DataFrame) -> DataFrame:
    """AG-04 in the reference's shape: triggered rows of the long table
    grouped by complaint_id (at most six rows a group), policies and reasons
    ordered by policy id via `array_sort(collect_list(struct))`.  It needs a
    shuffle by complaint_id; `with_rollup` computes the same columns in-row."""
    from ledgerline.functions import confidence_rank
    t = evals_long.filter(F.col("triggered"))
    agg = t.groupBy("complaint_id").agg(
        F.array_sort(F.collect_list(F.struct("policy_id", "reason_code"))).alias("_s"),
        F.min(confidence_rank("signal_confidence")).alias("min_confidence_rank"),
        *[F.bool_or(F.col("policy_id") == pid).alias(flag) for pid, flag in [
            ("POLICY_INCOMPLETE_CONTEXT", "incomplete_triggered"), ("POLICY_PUBLICATION_LAG", "lag_triggered"),
            ("POLICY_CRITICAL_COMBINATION", "critical_triggered"), ("POLICY_UNTIMELY_RESPONSE", "untimely_triggered"),
            ("POLICY_EMERGING_ISSUE", "emerging_triggered")]])
    return agg.select("complaint_id", F.col("_s.policy_id").alias("triggered_policy_ids"),
                      F.col("_s.reason_code").alias("triggered_reason_codes"), "min_confidence_rank",
                      "incomplete_triggered", "lag_triggered", "critical_triggered", "untimely_triggered",
                      "emerging_triggered")


def attach_rollup(sig: DataFrame, roll: DataFrame) -> DataFrame:
    """JN-05: signals x triggered roll-up, left on complaint_id (a record with
    no triggered policy keeps NULL arrays and flags and falls to LOW)."""
    return sig.join(roll, "complaint_id", "left")


def decide_via_join(sig: DataFrame, limited_products: tuple[str, ...] = ()) -> DataFrame:
    """The reference-shaped decision path: long table -> grouped roll-up ->
    join back -> precedence -> confidence.  Same result as `decide`."""
    roll = grouped_rollup(evaluate_long(sig, limited_products))
    return with_confidence(with_precedence(attach_rollup(sig, roll)))


def with_precedence(df: DataFrame) -> DataFrame:
    """DEC-07: incomplete -> lag -> critical -> untimely -> emerging -> LOW."""
    c = F.col
    prio = (F.when(c("incomplete_triggered"), "MEDIUM").when(c("lag_triggered"), "MEDIUM")
             .when(c("critical_triggered"), "CRITICAL").when(c("untimely_triggered"), "HIGH")
             .when(c("emerging_triggered"), "HIGH").otherwise("LOW"))
    action = (F.when(c("incomplete_triggered"), "REQUIRE_HUMAN_REVIEW")
               .when(c("lag_triggered"), "REQUIRE_HUMAN_REVIEW")
               .when(c("critical_triggered"), "ESCALATE_REVIEW")
               .when(c("untimely_triggered"), "ESCALATE_REVIEW")
               .when(c("emerging_triggered"), "INVESTIGATE_PATTERN").otherwise("STANDARD_HANDLING"))
    return df.withColumns({"priority": prio, "recommended_action": action})


def with_confidence(df: DataFrame) -> DataFrame:
    """DEC-08: weakest contributing confidence; nothing triggered -> HIGH."""
    return df.withColumn("signal_confidence", confidence_label("min_confidence_rank"))


def evidence() -> Column:
    """DEC-09: evidence object of nine signals (NULL members are dropped by to_json)."""
    return F.struct(*[F.col(n) for n in [
        "timely_response_status", "company_response", "issue_pattern_status", "issue_volume_current",
        "baseline_volume", "volume_change_pct", "observed_share_pct", "data_completeness_status",
        "recent_publication_lag_flag"]])


def limitation() -> Column:
    """DEC-10: lag text first, then LIMITED text, else NULL."""
    return (F.when(F.col("recent_publication_lag_flag"), F.lit(fixed.LAG_LIMITATION))
             .when(F.col("signal_confidence") == "LIMITED", F.lit(fixed.LIMITED_LIMITATION))
             .otherwise(F.lit(None).cast("string")))


def decide(signals: DataFrame, limited_products: tuple[str, ...] = ()) -> DataFrame:
    """Signals -> signals + triggers + roll-up + priority/action/confidence.
    The per-policy `evaluations` array is added lazily by `with_evaluations`
    only where the long table is asked for."""
    return with_confidence(with_precedence(with_rollup(signals, limited_products)))


QUEUE_COLUMNS = [
    "recommendation_id", "complaint_id", "priority", "recommended_action", "reason_codes", "policy_ids",
    "evidence_fields", "signal_confidence", "interpretation_limitation", "human_review_required",
    "recent_publication_lag_flag", "data_completeness_status", "source_snapshot_date",
    "policy_version", "model_version", "generated_at",
]


def action_queue(decided: DataFrame, p: Params, *keep: str) -> DataFrame:
    """DEC-09..11: the resolution action queue (one row per record), with columns `keep`.
    source_snapshot_date is the load's snapshot, not the build date."""
    return decided.select(
        surrogate_key(F.col("complaint_id"), F.lit(p.model_version)).alias("recommendation_id"),
        "complaint_id", "priority", "recommended_action",
        F.col("triggered_reason_codes").alias("reason_codes"),
        F.col("triggered_policy_ids").alias("policy_ids"),
        evidence().alias("evidence_fields"),
        "signal_confidence",
        limitation().alias("interpretation_limitation"),
        (F.col("recommended_action") != "STANDARD_HANDLING").alias("human_review_required"),
        "recent_publication_lag_flag", "data_completeness_status",
        F.coalesce(F.lit(p.snapshot_date).cast("date"), F.col("source_snapshot_date")).alias("source_snapshot_date"),
        F.lit(p.policy_version).alias("policy_version"),
        F.lit(p.model_version).alias("model_version"),
        F.current_timestamp().alias("generated_at"),
        *keep,
    )


def context_summary(p: Params) -> Column:
    """DEC-12: deterministic case summary; optional parts fall back to text."""
    c = F.col
    pct = F.concat(F.lit(" ("), fmt_fixed(c("volume_change_pct") * 100, 1), F.lit("% change; "),
                   fmt_fixed(c("observed_share_pct") * 100, 2),
                   F.lit("% of observed complaints in this window)"))
    return F.concat(
        F.lit("Complaint record "), c("complaint_id"),
        F.lit(", received "), c("complaint_received_date").cast("string"),
        F.lit(", concerns "), c("product"), F.lit(" / "), c("issue"), F.lit(". "),
        F.lit("Published response status: "), F.coalesce(c("company_response"), F.lit("unknown")), F.lit(". "),
        F.lit("Published timeliness signal: "), c("timely_response_status"), F.lit(". "),
        F.lit("The related issue pattern is "), F.coalesce(c("issue_pattern_status"), F.lit(fixed.NO_SIGNAL)),
        F.lit(", based on "), F.coalesce(c("issue_volume_current").cast("string"), F.lit("unknown")),
        F.lit(" observed complaints against a baseline of "),
        F.coalesce(fmt_fixed(c("baseline_volume"), 1), F.lit("unknown")),
        F.lit(f" over the configured {p.cur}-day comparison"),
        F.coalesce(pct, F.lit("")), F.lit(". "),
        F.lit("Confidence: "), F.coalesce(c("signal_confidence"), F.lit("unknown")), F.lit(". "),
        F.lit("Recommended operational action: "), F.coalesce(c("recommended_action"), F.lit("unknown")),
        F.lit(". "),
        F.lit("Reasons: "), F.coalesce(F.array_join(c("reason_codes"), ", "), F.lit("none")), F.lit("."),
        F.coalesce(F.concat(F.lit(" Limitation: "), c("interpretation_limitation")), F.lit("")),
    )
