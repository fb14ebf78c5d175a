"""Fixed values that must equal the reference's for right results.

Everything in this module is data, stated plainly and in natural order:
policy metadata, precedence, confidence ranks, closed value domains,
product families, limitation texts and governance patterns.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES: the six decision policies.
# (policy_id, priority, recommended_action, reason_code, signal_confidence,
#  human_review_required)
# --------------------------------------------------------------------------
POLICIES = [
    ("POLICY_UNTIMELY_RESPONSE", "HIGH", "ESCALATE_REVIEW", "PUBLISHED_UNTIMELY_RESPONSE", "HIGH", True),
    ("POLICY_EMERGING_ISSUE", "HIGH", "INVESTIGATE_PATTERN", "EMERGING_ISSUE_SIGNAL", "MEDIUM", True),
    ("POLICY_PUBLICATION_LAG", "MEDIUM", "REQUIRE_HUMAN_REVIEW", "RECENT_PUBLICATION_LAG", "LIMITED", True),
    ("POLICY_INCOMPLETE_CONTEXT", "MEDIUM", "REQUIRE_HUMAN_REVIEW", "INCOMPLETE_CONTEXT", "LIMITED", True),
    ("POLICY_STABLE_PATTERN", "LOW", "STANDARD_HANDLING", "STABLE_PATTERN", "HIGH", False),
    ("POLICY_CRITICAL_COMBINATION", "CRITICAL", "ESCALATE_REVIEW", "MULTIPLE_QUALIFIED_TRIGGERS", "MEDIUM", True),
]
POLICY_IDS = [p[0] for p in POLICIES]

# FIXED VALUES: the audited thresholds seed.  (policy_id, trend_grain, current_window_days, baseline_window_days,
# min_current_volume, min_baseline_volume, minimum_pct_change, publication_lag_window_days, min_triggered_high_policies,
# priority, action, reason_code, signal_confidence, human_review_required)
THRESHOLDS = [
    ("POLICY_UNTIMELY_RESPONSE", None, 0, 0, 0, 0, None, None, 1, "HIGH", "ESCALATE_REVIEW", "PUBLISHED_UNTIMELY_RESPONSE", "HIGH", True),
    ("POLICY_EMERGING_ISSUE", "product_issue", 7, 30, 20, 50, 0.30, None, 1, "HIGH", "INVESTIGATE_PATTERN", "EMERGING_ISSUE_SIGNAL", "MEDIUM", True),
    ("POLICY_PUBLICATION_LAG", None, 0, 0, 0, 0, None, 60, 1, "MEDIUM", "REQUIRE_HUMAN_REVIEW", "RECENT_PUBLICATION_LAG", "LIMITED", True),
    ("POLICY_INCOMPLETE_CONTEXT", None, 0, 0, 0, 0, None, None, 1, "MEDIUM", "REQUIRE_HUMAN_REVIEW", "INCOMPLETE_CONTEXT", "LIMITED", True),
    ("POLICY_STABLE_PATTERN", None, 0, 0, 0, 0, None, None, 0, "LOW", "STANDARD_HANDLING", "STABLE_PATTERN", "HIGH", False),
    ("POLICY_CRITICAL_COMBINATION", None, 0, 0, 0, 0, None, None, 2, "CRITICAL", "ESCALATE_REVIEW", "MULTIPLE_QUALIFIED_TRIGGERS",
     "LOWEST_OF_CONTRIBUTORS", True),
]

# FIXED VALUES: confidence ranks (weakest contributing confidence wins).
CONFIDENCE_RANK = {"HIGH": 4, "MEDIUM": 3, "LIMITED": 2, "NOT_SUPPORTED": 1}

# FIXED VALUES: trend pattern statuses.
QUALIFIED = "QUALIFIED_SIGNAL"
UNQUALIFIED = "UNQUALIFIED_SIGNAL"
INSUFFICIENT_BASELINE = "INSUFFICIENT_BASELINE"
NO_SIGNAL = "NO_SIGNAL"
TREND_POLICY_ID = "POLICY_EMERGING_ISSUE"
STABLE_POLICY_ID = "POLICY_STABLE_PATTERN"

# FIXED VALUES: surrogate-key null token and separator (public dbt_utils contract).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"

# FIXED VALUES: policy-combination separator used by the archive exhibits.
COMBO_SEP = "|"

# FIXED VALUES: closed value domains (field, accepted value).
ACCEPTED_VALUES = {
    "company_response": [
        "Closed with explanation", "Closed with non-monetary relief", "Closed with monetary relief",
        "In progress", "Untimely response", "Closed", "Closed with relief", "Closed without relief",
    ],
    "timely_response_status": ["YES", "NO", "UNKNOWN"],
    "submitted_via": ["Web", "Referral", "Phone", "Postal mail", "Fax", "Email"],
    "priority": ["LOW", "MEDIUM", "HIGH", "CRITICAL"],
    "signal_confidence": ["HIGH", "MEDIUM", "LIMITED", "NOT_SUPPORTED"],
    "recommended_action": ["STANDARD_HANDLING", "PRIORITIZE_CASE_REVIEW", "ESCALATE_REVIEW", "INVESTIGATE_PATTERN",
                           "REQUIRE_HUMAN_REVIEW", "UPDATE_AGENT_GUIDANCE"],
    "issue_pattern_status": ["QUALIFIED_SIGNAL", "UNQUALIFIED_SIGNAL", "INSUFFICIENT_BASELINE", "NO_SIGNAL"],
    "data_completeness_status": ["COMPLETE", "PARTIAL", "INSUFFICIENT"],
}

# FIXED VALUES: action playbook (action, meaning, owner, human_review_required, prohibited_use).
PLAYBOOK = [
    ("STANDARD_HANDLING", "No special operational signal identified by this product", "Operations queue", False,
     "Do not treat as a quality endorsement"),
    ("PRIORITIZE_CASE_REVIEW", "Review this record sooner due to a documented service signal", "Resolution manager",
     True, "Not a judgment of complaint validity"),
    ("ESCALATE_REVIEW", "Route to a supervisor or specialist review workflow", "Supervisor", True,
     "Not an adverse action or account decision"),
    ("INVESTIGATE_PATTERN", "Investigate a potential emerging issue pattern", "Operations or product", True,
     "Not a confirmed incident root cause or market event"),
    ("REQUIRE_HUMAN_REVIEW", "Source data or policy condition is incomplete or ambiguous", "Resolution manager", True,
     "Do not auto-resolve or infer the missing value"),
    ("UPDATE_AGENT_GUIDANCE", "Consider knowledge or routing guidance for a documented aggregate pattern",
     "Knowledge owner", True, "Not an automated content change"),
]

# FIXED VALUES: raw source contract, in order (column name, CSV header).
RAW_COLUMNS = [
    ("date_received", "Date received"),
    ("product", "Product"),
    ("sub_product", "Sub-product"),
    ("issue", "Issue"),
    ("sub_issue", "Sub-issue"),
    ("consumer_complaint_narrative", "Consumer complaint narrative"),
    ("company_public_response", "Company public response"),
    ("company", "Company"),
    ("state", "State"),
    ("zip_code", "ZIP code"),
    ("tags", "Tags"),
    ("submitted_via", "Submitted via"),
    ("date_sent_to_company", "Date sent to company"),
    ("company_response_to_consumer", "Company response to consumer"),
    ("timely_response", "Timely response?"),
    ("complaint_id", "Complaint ID"),
]

# FIXED VALUES: interpretation texts.
COMPANY_LIMITATION = (
    "No denominator exists for this company (customer count, account count, or transaction volume). "
    "This count describes complaint volume only and must never be read as a company quality, risk, "
    "performance, or misconduct signal, and must never be used to rank or compare companies."
)
LAG_LIMITATION = (
    "Response status may be incomplete: this record falls within the trailing publication-lag window. "
    "Treat any response-status signal as directional, not final."
)
LIMITED_LIMITATION = (
    "This recommendation is affected by a documented source coverage or completeness limitation. "
    "See the known-limitations notes."
)

# FIXED VALUES: governance patterns.
FORBIDDEN_SUBSTRINGS = ["narrative", "tags", "zip", "consumer_disputed"]
FORBIDDEN_EXCEPTIONS = ["has_narrative"]
DURATION_PATTERNS = [
    "response_days", "resolution_days", "days_to_respond", "time_to_resolution",
    "handling_time", "response_duration", "resolution_duration", "elapsed",
]
CASE_CONTEXT_ALLOWLIST = [
    "complaint_id", "complaint_received_date", "product", "sub_product", "issue", "sub_issue",
    "submitted_via", "company_response", "timely_response_status", "company_public_response",
    "has_narrative", "issue_volume_current", "baseline_volume", "volume_change_pct",
    "observed_share_pct", "issue_pattern_status", "recent_publication_lag_flag",
    "data_completeness_status", "signal_confidence", "interpretation_limitation", "priority",
    "recommended_action", "reason_codes", "policy_ids", "context_summary", "generated_at",
]
METRICS_ALLOWLIST = ["metric_date", "dashboard_dimension", "metric_name", "metric_value", "generated_at"]

# FIXED VALUES: product families of the published archive (family_id, label, members).
ARCHIVE_FAMILIES = [
    ("credit-reporting", "Credit reporting", [
        "Credit reporting",
        "Credit reporting, credit repair services, or other personal consumer reports",
        "Credit reporting or other personal consumer reports"]),
    ("debt-collection", "Debt collection", ["Debt collection"]),
    ("mortgage", "Mortgage", ["Mortgage"]),
    ("bank-account", "Checking and savings", ["Bank account or service", "Checking or savings account"]),
    ("cards", "Credit and prepaid cards", ["Credit card", "Credit card or prepaid card", "Prepaid card"]),
    ("student-loan", "Student loan", ["Student loan"]),
    ("vehicle-consumer-loan", "Vehicle and consumer loans", ["Consumer Loan", "Vehicle loan or lease"]),
    ("payday-personal-loan", "Payday and personal loans", [
        "Payday loan", "Payday loan, title loan, or personal loan",
        "Payday loan, title loan, personal loan, or advance loan"]),
    ("money-transfer", "Money transfer and virtual currency", [
        "Money transfers", "Virtual currency", "Money transfer, virtual currency, or money service"]),
    ("debt-credit-management", "Debt or credit management", ["Debt or credit management"]),
    ("other-financial-service", "Other financial service", ["Other financial service"]),
]

# FIXED VALUES: family dimension for the driver's orders fixture
# (HOUSEHOLD is deliberately unmapped so the gap report returns rows).
FIXTURE_FAMILIES = [
    ("automobile", "Automobile", ["AUTOMOBILE (LEGACY)", "AUTOMOBILE"]),
    ("building", "Building", ["BUILDING"]),
    ("furniture", "Furniture", ["FURNITURE"]),
    ("machinery", "Machinery", ["MACHINERY"]),
]

# FIXED VALUES: taxonomy-change markers (month, label).
TAXONOMY_CHANGES = [("2017-04", "CFPB renamed categories"), ("2023-08", "CFPB renamed categories")]
FIXTURE_TAXONOMY_CHANGES = [("1998-01", "Segment renamed")]

# FIXED VALUES: trend classes.
TREND_GROWING, TREND_STEADY, TREND_DECLINING, TREND_ENDED, TREND_NEW = (
    "growing", "steady", "declining", "ended", "new")

# Output columns of the signals, the operations metrics and the case context, in contract order.
SIGNAL_COLUMNS = [
    "complaint_id", "complaint_received_date", "cfpb_routing_date", "product", "sub_product", "issue",
    "sub_issue", "company", "state", "submitted_via", "company_response", "timely_response_status",
    "company_public_response", "has_narrative", "recent_publication_lag_flag", "data_completeness_status",
    "issue_volume_current", "baseline_volume", "volume_change_pct", "observed_share_pct",
    "issue_pattern_status", "trend_policy_id",
]
METRIC_COLUMNS = ["metric_date", "dashboard_dimension", "metric_name", "metric_value", "generated_at"]
CASE_COLUMNS = [
    "complaint_id", "complaint_received_date", "product", "sub_product", "issue", "sub_issue",
    "submitted_via", "company_response", "timely_response_status", "company_public_response",
    "has_narrative", "issue_volume_current", "baseline_volume", "volume_change_pct", "observed_share_pct",
    "issue_pattern_status", "recent_publication_lag_flag", "data_completeness_status",
    "signal_confidence", "interpretation_limitation", "priority", "recommended_action", "reason_codes",
    "policy_ids", "generated_at",
]
