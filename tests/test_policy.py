import json

from pyspark.sql import functions as F

from ledgerline.operators import policy
from ledgerline.params import Params

P = Params()
SCHEMA = ("complaint_id string, timely_response_status string, issue_pattern_status string, "
          "recent_publication_lag_flag boolean, data_completeness_status string, company_response string, "
          "issue_volume_current long, baseline_volume double, volume_change_pct double, observed_share_pct double, "
          "source_snapshot_date date")


def _decide(spark, rows):
    df = spark.createDataFrame([r + ("Closed", 10, 5.0, 1.0, 0.1, None) for r in rows], SCHEMA)
    q = policy.action_queue(policy.decide(df), P)
    return {r.complaint_id: r for r in q.collect()}


def test_critical_keeps_all_reasons(spark):
    r = _decide(spark, [("c", "NO", "QUALIFIED_SIGNAL", False, "COMPLETE")])["c"]
    assert (r.priority, r.recommended_action, r.signal_confidence) == ("CRITICAL", "ESCALATE_REVIEW", "MEDIUM")
    assert r.policy_ids == ["POLICY_CRITICAL_COMBINATION", "POLICY_EMERGING_ISSUE", "POLICY_UNTIMELY_RESPONSE"]
    assert r.reason_codes == ["MULTIPLE_QUALIFIED_TRIGGERS", "EMERGING_ISSUE_SIGNAL", "PUBLISHED_UNTIMELY_RESPONSE"]


def test_lag_overrides_critical(spark):
    r = _decide(spark, [("l", "NO", "QUALIFIED_SIGNAL", True, "COMPLETE")])["l"]
    assert (r.priority, r.recommended_action, r.signal_confidence) == ("MEDIUM", "REQUIRE_HUMAN_REVIEW", "LIMITED")
    assert r.interpretation_limitation.startswith("Response status may be incomplete")


def test_stable_and_untimely(spark):
    got = _decide(spark, [("s", "YES", "NO_SIGNAL", False, "COMPLETE"), ("u", "NO", "NO_SIGNAL", False, "COMPLETE")])
    s, u = got["s"], got["u"]
    assert (s.priority, s.recommended_action, s.signal_confidence, s.human_review_required) == \
        ("LOW", "STANDARD_HANDLING", "HIGH", False)
    assert s.policy_ids == ["POLICY_STABLE_PATTERN"]
    assert (u.priority, u.recommended_action, u.signal_confidence) == ("HIGH", "ESCALATE_REVIEW", "HIGH")


def test_incomplete_is_limited(spark):
    r = _decide(spark, [("i", "YES", "NO_SIGNAL", False, "PARTIAL")])["i"]
    assert (r.priority, r.signal_confidence) == ("MEDIUM", "LIMITED")
    assert "limitation" in r.interpretation_limitation


def test_null_pattern_status_falls_to_low_with_null_arrays(spark):
    r = _decide(spark, [("n", "YES", None, False, "COMPLETE")])["n"]
    assert (r.priority, r.recommended_action, r.signal_confidence) == ("LOW", "STANDARD_HANDLING", "HIGH")
    assert r.policy_ids is None and r.reason_codes is None


def test_evidence_json_drops_nulls(spark):
    df = spark.createDataFrame([("e", "YES", None, False, "COMPLETE", None, None, None, None, None, None)], SCHEMA)
    q = policy.action_queue(policy.decide(df), P)
    ev = json.loads(q.select(F.to_json("evidence_fields").alias("j")).collect()[0].j)
    assert "company_response" not in ev and ev["timely_response_status"] == "YES"


def test_long_table_has_six_rows_per_record(spark):
    df = spark.createDataFrame([("a", "NO", "QUALIFIED_SIGNAL", False, "COMPLETE", "x", 1, 1.0, 1.0, 1.0, None)],
                               SCHEMA)
    rows = policy.evaluate_long(df).collect()
    assert len(rows) == 6 and sum(1 for r in rows if r.triggered) == 3


def test_in_row_rollup_equals_grouped_rollup_for_every_trigger_combination(spark):
    """Exhaustive: all timely x status x lag x completeness inputs (NULLs
    included) give the same decision via the in-row roll-up as via the
    union-style long table grouped by complaint_id and joined back."""
    import itertools
    timely = ["YES", "NO", "UNKNOWN"]
    status = ["QUALIFIED_SIGNAL", "UNQUALIFIED_SIGNAL", "NO_SIGNAL", "INSUFFICIENT_BASELINE", None]
    lag = [True, False]
    comp = ["COMPLETE", "PARTIAL", "INSUFFICIENT"]
    rows = [(str(i), t, s, lg, c) for i, (t, s, lg, c) in enumerate(itertools.product(timely, status, lag, comp))]
    df = spark.createDataFrame([r + ("Closed", 1, 1.0, 1.0, 1.0, None) for r in rows], SCHEMA)
    cols = ["complaint_id", "triggered_policy_ids", "triggered_reason_codes", "priority", "recommended_action",
            "signal_confidence"]
    a = sorted(tuple(map(str, r)) for r in policy.decide(df).select(*cols).collect())
    b = sorted(tuple(map(str, r)) for r in policy.decide_via_join(df).select(*cols).collect())
    assert a == b and len(a) == len(rows)
