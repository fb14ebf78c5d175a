"""Staging / conform operators (PRJ-01..PRJ-10, PRJ-13..PRJ-14).

All are narrow (row-local) transformations: no shuffle, fully pipelined in
one whole-stage-codegen span after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import clean, null_literal, present, timely_status
from ledgerline.params import Params

LINEAGE = [
    ("source_system", "string"), ("source_url", "string"), ("source_retrieved_at", "timestamp_ntz"),
    ("source_file_name", "string"), ("source_snapshot_date", "date"), ("loaded_at", "timestamp_ntz"),
    ("load_run_id", "string"),
]

REQUIRED = ["complaint_id", "product", "issue", "complaint_received_date"]


def _lineage_cols(df: DataFrame):
    have = set(df.columns)
    return [(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in LINEAGE]


def conform(raw: DataFrame) -> DataFrame:
    """PRJ-01..05: rename, trim/NULL-normalise, parse dates, timely status,
    narrative presence; lineage passes through (missing lineage -> NULL)."""
    return raw.select(
        clean("complaint_id").alias("complaint_id"),
        F.try_to_date(F.col("date_received")).alias("complaint_received_date"),
        F.try_to_date(F.col("date_sent_to_company")).alias("cfpb_routing_date"),
        clean("product").alias("product"),
        clean("sub_product").alias("sub_product"),
        clean("issue").alias("issue"),
        clean("sub_issue").alias("sub_issue"),
        clean("company").alias("company"),
        clean("state").alias("state"),
        clean("zip_code").alias("zip_code"),
        clean("submitted_via").alias("submitted_via"),
        clean("company_response_to_consumer").alias("company_response"),
        timely_status("timely_response").alias("timely_response_status"),
        null_literal("company_public_response").alias("company_public_response"),
        null_literal("tags").alias("tags"),
        present("consumer_complaint_narrative").alias("has_narrative"),
        *_lineage_cols(raw),
    )


def with_lag_flag(df: DataFrame, p: Params) -> DataFrame:
    """PRJ-06: received within lag_days of the snapshot, or still 'In progress'."""
    recent = F.col("complaint_received_date") >= F.date_sub("source_snapshot_date", p.lag_days)
    in_progress = F.coalesce(F.col("company_response") == "In progress", F.lit(False))
    return df.withColumn("recent_publication_lag_flag", recent | in_progress)


def required_only(df: DataFrame, keys: list[str] = REQUIRED) -> DataFrame:
    """PRJ-07: drop rows missing any required field (pushed below the projection)."""
    return df.dropna(subset=keys)


def with_completeness(df: DataFrame) -> DataFrame:
    """PRJ-08: INSUFFICIENT / PARTIAL / COMPLETE."""
    c = F.col
    status = (F.when(c("complaint_id").isNull() | c("complaint_received_date").isNull()
                     | c("product").isNull() | c("issue").isNull(), "INSUFFICIENT")
               .when(c("sub_product").isNull() | c("sub_issue").isNull() | c("company_response").isNull(),
                     "PARTIAL")
               .otherwise("COMPLETE"))
    return df.withColumn("data_completeness_status", status)


def stage(raw: DataFrame, p: Params) -> DataFrame:
    """stg: conform + lag flag + required-field filter."""
    return required_only(with_lag_flag(conform(raw), p))


def status_context(raw: DataFrame, p: Params) -> DataFrame:
    """ctx: staged records + completeness (the record grain used downstream)."""
    return with_completeness(stage(raw, p))


FACT_COLUMNS = [
    "complaint_id", "complaint_received_date", "cfpb_routing_date", "issue_taxonomy_key", "product",
    "sub_product", "issue", "sub_issue", "company", "state", "submitted_via", "company_response",
    "timely_response_status", "company_public_response", "has_narrative", "recent_publication_lag_flag",
    "data_completeness_status", "source_system", "source_url", "source_retrieved_at",
    "source_snapshot_date", "load_run_id", "generated_at",
]


def forbidden_columns(columns: list[str]) -> list[str]:
    """Names that match a forbidden pattern (SNK-03 / DQ-Q)."""
    out = []
    for name in columns:
        low = name.lower()
        if low in fixed.FORBIDDEN_EXCEPTIONS:
            continue
        if any(s in low for s in fixed.FORBIDDEN_SUBSTRINGS):
            out.append(name)
    return out
