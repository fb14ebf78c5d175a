"""Tables with planted violations, on Spark and in DuckDB alike, so that every
check has something to find.

A rule marks rows by the record id (or the day of the month, or the sub-issue
of taxonomy rows): one class loses its required columns, one gets values
outside every domain, one occurs twice.  The queue also gets criticals without
a trigger, decisions without reasons or evidence, and unknown records.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVIDENCE = ["issue_volume_current", "baseline_volume", "volume_change_pct", "observed_share_pct", "issue_pattern_status",
            "timely_response_status", "company_response", "recent_publication_lag_flag"]
BAD = "UNEXPECTED"

# table: (mark of rows, by kind; columns that lose values; columns that get BAD)
RECORD, DAY, TAXONOMY = "CAST(complaint_id AS bigint) % {n} = 0", "day(metric_date) = {n}", "sub_issue = 'sub-{n}'"
KINDS = {RECORD: (97, 101, 103), DAY: (13, 14, 15), TAXONOMY: (3, 4, 5)}
TABLES = {
    "raw_cases": (RECORD, ["complaint_id", "date_received", "product", "issue", "company", "submitted_via",
                           "company_response_to_consumer", "timely_response"], []),
    "stg": (RECORD, ["complaint_id", "complaint_received_date", "recent_publication_lag_flag"], ["timely_response_status"]),
    "ctx": (RECORD, ["complaint_id", "complaint_received_date", "product", "issue"], ["data_completeness_status"]),
    "vol": (DAY, ["metric_date", "product", "issue", "complaint_count"], []),
    "trends": (DAY, ["metric_date", "product", "issue", "daily_complaint_count"], ["issue_pattern_status"]),
    "patterns": (DAY, ["metric_date", "company", "product", "issue", "complaint_count"], ["signal_confidence"]),
    "policies": (RECORD, ["complaint_id", "triggered", "human_review_required"],
                 ["policy_id", "priority", "recommended_action", "signal_confidence"]),
    "signals": (RECORD, ["complaint_id"], ["data_completeness_status", "issue_pattern_status"]),
    "cases": (RECORD, ["complaint_id", "context_summary"], ["signal_confidence"]),
    "dim": (TAXONOMY, ["issue_taxonomy_key", "product", "issue"], []),
    "fct": (RECORD, ["complaint_id", "complaint_received_date", "product", "issue"],
            ["timely_response_status", "data_completeness_status", "company_response", "submitted_via"]),
    "fdm": (DAY, ["metric_date", "product", "issue", "daily_complaint_count"], ["issue_pattern_status"]),
    "queue": (RECORD, ["recommendation_id", "priority", "recommended_action", "signal_confidence", "model_version", "policy_version"],
              ["priority", "recommended_action", "signal_confidence"]),
    "ops": (DAY, ["metric_date", "metric_name"], []),
}
# More for the queue: (column, mark, value in Spark, value in SQL)
QUEUE_MORE = [("priority", 109, "'CRITICAL'"), ("complaint_id", 113, "concat('X', complaint_id)")]
NO_REASONS, NO_EVIDENCE = 107, 127


def _cases(table: str) -> tuple[list[tuple[str, str, str]], str]:
    """(column, mark, value) in order, first match per column wins; and the mark of doubled rows."""
    by, nulls, bad = TABLES[table]
    lost, odd, twice = (by.format(n=n) for n in KINDS[by])
    out = [(c, lost, "NULL") for c in nulls] + [(c, odd, f"'{BAD}'") for c in bad]
    if table == "queue":
        out += [(c, by.format(n=n), v) for c, n, v in QUEUE_MORE]
    return out, twice


def seed(table: str, df: DataFrame) -> DataFrame:
    cases, twice = _cases(table)
    kinds = dict(df.dtypes)
    new = {}
    for column in dict.fromkeys(c for c, _, _ in cases):
        e = F.col(column)
        for _, mark, value in reversed([x for x in cases if x[0] == column]):
            e = F.when(F.expr(mark), F.expr(value).cast(kinds[column])).otherwise(e)
        new[column] = e
    if table == "queue":
        no_reason, no_evidence = (F.expr(RECORD.format(n=n)) for n in (NO_REASONS, NO_EVIDENCE))
        new["reason_codes"] = F.when(no_reason, F.array().cast(kinds["reason_codes"])).otherwise(F.col("reason_codes"))
        new["evidence_fields"] = F.when(~no_evidence, F.col("evidence_fields"))
    return df.unionByName(df.filter(F.expr(twice))).withColumns(new)


def seed_sql(table: str) -> str:
    cases, twice = _cases(table)
    new = []
    for column in dict.fromkeys(c for c, _, _ in cases):
        whens = " ".join(f"WHEN {mark} THEN {value}" for c, mark, value in cases if c == column)
        new.append(f"CASE {whens} ELSE {column} END AS {column}")
    if table == "queue":
        new.append(f"CASE WHEN {RECORD.format(n=NO_REASONS)} THEN [] ELSE reason_codes END AS reason_codes")
        new += [f"CASE WHEN {RECORD.format(n=NO_EVIDENCE)} THEN NULL ELSE {c} END AS {c}" for c in EVIDENCE if c != "recent_publication_lag_flag"]
    source = f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE {twice})"
    return f"{table}_x AS (SELECT * REPLACE ({', '.join(new)}) FROM {source})"


# What the checks that compare two tables get: a day counted once too often, records left out.
OTHER_SQL = """
fdm_counts AS (SELECT product, issue, daily_complaint_count FROM fdm),
fdm_counts_x AS (SELECT product, issue, daily_complaint_count + CAST(day(metric_date) = 1 AS integer) AS daily_complaint_count FROM fdm),
stg_rows AS (FROM stg),
stg_rows_x AS (FROM stg WHERE CAST(complaint_id AS bigint) % 5 <> 0),
dim_rows AS (FROM dim),
dim_rows_x AS (FROM dim WHERE sub_issue IS DISTINCT FROM 'sub-3')
"""


def frames(p) -> dict[str, SimpleNamespace]:
    """clean and seeded tables of a pipeline, by name."""
    clean = {"raw_cases": p.raw, "stg": p.staged, "ctx": p.records, "vol": p.vol, "trends": p.trends, "patterns": p.patterns,
             "policies": p.evals, "signals": p.signals, "cases": p.cases, "dim": p.dim, "fct": p.fct, "fdm": p.fdm, "queue": p.queue,
             "ops": p.ops}
    seeded = {k: seed(k, v) for k, v in clean.items()}
    other = {"fdm_counts": (p.fdm, p.fdm.withColumn("daily_complaint_count", F.col("daily_complaint_count") + (F.dayofmonth("metric_date") == 1).cast("int"))),
             "stg_rows": (p.staged, p.staged.filter(F.expr("CAST(complaint_id AS bigint) % 5 <> 0"))),
             "dim_rows": (p.dim, p.dim.filter(~F.col("sub_issue").eqNullSafe(F.lit("sub-3"))))}
    clean |= {k: v[0] for k, v in other.items()}
    seeded |= {k: v[1] for k, v in other.items()}
    return {"clean": SimpleNamespace(**clean, records=p.records, raw=p.raw), "seeded": SimpleNamespace(**seeded, records=p.records, raw=p.raw)}


PATTERNS_SQL = """patterns AS (
  SELECT complaint_received_date AS metric_date, company, product, issue, count(*) AS complaint_count, 'LIMITED' AS signal_confidence
  FROM ctx WHERE company IS NOT NULL GROUP BY ALL),
ops AS (
  SELECT metric_date, product AS dashboard_dimension, 'complaint_volume' AS metric_name, daily_complaint_count AS metric_value FROM fdm
  UNION ALL SELECT metric_date, product, 'emerging_issue_count', count(*) FROM fdm WHERE issue_pattern_status = 'QUALIFIED_SIGNAL' GROUP BY ALL
  UNION ALL SELECT source_snapshot_date, recommended_action, 'action_count', count(*) FROM queue GROUP BY ALL)"""


def both_sql(body) -> str:
    """body(suffix) for the clean ('') and the seeded ('_x') tables, told apart by `fixture`."""
    return (f", {PATTERNS_SQL}, {', '.join(seed_sql(t) for t in TABLES)}, {OTHER_SQL} "
            f"SELECT 'clean' AS fixture, * FROM ({body('')}) UNION ALL SELECT 'seeded', * FROM ({body('_x')})")


def both(p, check) -> DataFrame:
    out = None
    for name, tables in frames(p).items():
        df = check(tables).select(F.lit(name).alias("fixture"), "*")
        out = df if out is None else out.unionByName(df)
    return out
