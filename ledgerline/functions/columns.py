"""Column-expression helpers (FN-01..FN-26).

All helpers return `Column`s built from `pyspark.sql.functions`, so they
stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import fixed

__all__ = [
    "col_", "clean", "null_literal", "timely_status", "present", "safe_divide", "surrogate_key",
    "fmt_fixed", "round6", "month_start", "unix_day", "confidence_rank", "confidence_label",
    "combo_policies", "json_string_array", "shift_month", "title_case", "reason_sentence",
    "next_step", "masked_zip", "date_axis", "days_before",
]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """FN-01 trim + empty -> NULL."""
    return F.nullif(F.trim(col_(c)), F.lit(""))


def null_literal(c: str | Column) -> Column:
    """PRJ-02: empty or the literal 'None' -> NULL, else trimmed."""
    t = F.trim(col_(c))
    return F.when(t.isin("", "None"), F.lit(None).cast("string")).otherwise(t)


def timely_status(c: str | Column) -> Column:
    """PRJ-04: upper(trim) YES / NO, anything else (incl. NULL) UNKNOWN."""
    u = F.upper(F.trim(col_(c)))
    return F.when(u == "YES", "YES").when(u == "NO", "NO").otherwise("UNKNOWN")


def present(c: str | Column) -> Column:
    """PRJ-05: presence flag; the text itself never passes."""
    return clean(c).isNotNull()


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """FN-09: NULL when the denominator is NULL or 0, float division otherwise."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def surrogate_key(*cols: str | Column) -> Column:
    """FN-15: md5 of '-'-joined string casts; NULL parts become a fixed token."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(fixed.SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(fixed.SURROGATE_SEP, *parts))


def fmt_fixed(c: str | Column, scale: int) -> Column:
    """FN-10: number -> text with exactly `scale` decimals (never exponent form)."""
    d = col_(c).cast("decimal(38,12)")
    return F.round(d, scale).cast(f"decimal(38,{scale})").cast("string")


def round6(c: str | Column) -> Column:
    """Doubles compared across engines are rounded to 6 places."""
    return F.round(col_(c).cast("decimal(38,12)"), 6).cast("double")


def month_start(c: str | Column) -> Column:
    """FN-05: first day of the month as DATE."""
    return F.trunc(col_(c).cast("date"), "MM")


def unix_day(c: str | Column) -> Column:
    """Day number, used as the ORDER BY key of calendar RANGE windows."""
    return F.unix_date(col_(c).cast("date"))


def days_before(d, n: int) -> Column:
    """FN-04: date minus n days (d may be a python date or a Column)."""
    base = F.lit(d) if not isinstance(d, Column) else d
    return F.date_sub(base, n)


def confidence_rank(c: str | Column) -> Column:
    """DEC-08 forward map: confidence label -> rank (unknown -> NULL)."""
    e = None
    for label, rank in fixed.CONFIDENCE_RANK.items():
        e = (F.when(col_(c) == label, F.lit(rank)) if e is None
             else e.when(col_(c) == label, F.lit(rank)))
    return e


def confidence_label(rank: str | Column, fallback: str = "HIGH") -> Column:
    """DEC-08 back map: rank -> label, NULL rank -> fallback."""
    e = None
    for label, r in fixed.CONFIDENCE_RANK.items():
        e = (F.when(col_(rank) == r, F.lit(label)) if e is None
             else e.when(col_(rank) == r, F.lit(label)))
    return e.otherwise(F.lit(fallback))


def combo_policies(c: str | Column, sep: str = fixed.COMBO_SEP) -> Column:
    """FN-20: combo string -> array of policies, dropping empties and STABLE."""
    parts = F.split(F.coalesce(col_(c), F.lit("")), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    return F.filter(parts, lambda x: (x != "") & (x != fixed.STABLE_POLICY_ID))


def json_string_array(c: str | Column) -> Column:
    """FN-21: JSON text array -> array<string>; malformed -> empty array."""
    return F.coalesce(F.from_json(col_(c), "array<string>", {"mode": "PERMISSIVE"}),
                      F.array().cast("array<string>"))


def shift_month(month_text: str | Column, k: int) -> Column:
    """FN-22: 'YYYY-MM' shifted by k months."""
    d = F.to_date(F.concat(col_(month_text), F.lit("-01")))
    return F.date_format(F.add_months(d, k), "yyyy-MM")


def title_case(c: str | Column, strip_prefix: str | None = None) -> Column:
    """FN-23: CODE_CASE -> 'Code case' style title text."""
    x = col_(c)
    if strip_prefix:
        x = F.regexp_replace(x, "^" + strip_prefix, "")
    return F.initcap(F.replace(F.lower(x), F.lit("_"), F.lit(" ")))


# FIXED VALUES: reason-code explanations and next steps per action.
REASON_TEXT = {
    "EMERGING_ISSUE_SIGNAL":
        "Volume for this pattern cleared the emerging-signal thresholds against its own baseline.",
    "PUBLISHED_UNTIMELY_RESPONSE":
        "The published record shows the company did not meet the reporting standard for this case.",
    "RECENT_PUBLICATION_LAG":
        "This pattern falls inside the recent-publication window, so its status may still change.",
    "INCOMPLETE_CONTEXT": "One or more fields needed to interpret this pattern are missing.",
    "MULTIPLE_QUALIFIED_TRIGGERS": "Two independent signals qualified on the same pattern.",
    "STABLE_PATTERN": "No qualifying signal fired for this pattern.",
}
NO_REASON_TEXT = "No qualifying signal fired for this pattern."
NEXT_STEP = {
    "ESCALATE_REVIEW": "Escalate now",
    "INVESTIGATE_PATTERN": "Investigate this trend",
    "REQUIRE_HUMAN_REVIEW": "Needs a person to check",
    "STANDARD_HANDLING": "No action needed",
    "PRIORITIZE_CASE_REVIEW": "Review sooner than usual",
    "UPDATE_AGENT_GUIDANCE": "Update agent guidance",
}


def reason_sentence(codes: str | Column) -> Column:
    """FN-24: reason codes -> explanation; unknown codes are skipped."""
    m = F.create_map(*[F.lit(x) for kv in REASON_TEXT.items() for x in kv])
    texts = F.filter(F.transform(F.coalesce(col_(codes), F.array().cast("array<string>")),
                                 lambda x: F.try_element_at(m, x)),
                     lambda t: t.isNotNull())
    return F.when(F.size(texts) == 0, F.lit(NO_REASON_TEXT)).otherwise(F.array_join(texts, " "))


def next_step(action: str | Column) -> Column:
    """FN-24: action -> next step; unknown actions are title-cased."""
    m = F.create_map(*[F.lit(x) for kv in NEXT_STEP.items() for x in kv])
    return F.coalesce(F.try_element_at(m, col_(action)), title_case(action))


def masked_zip(c: str | Column) -> Column:
    """FN-25: a ZIP containing X/x is privacy-masked."""
    return col_(c).rlike("[Xx]")


def date_axis(start: str | Column, stop: str | Column) -> Column:
    """FN-26: every calendar day from start to stop (array<date>)."""
    return F.sequence(col_(start).cast("date"), col_(stop).cast("date"), F.expr("interval 1 day"))
