"""Sinks (SNK-01..SNK-05): mart materialisation and governed exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.operators.conform import forbidden_columns
from ledgerline.session import checkpoint_dir, scratch_path


def warehouse_path(spark: SparkSession, name: str) -> str:
    """Default location for materialised marts: under the session's shared
    checkpoint folder (never a machine-local temp dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/marts/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once under the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> DataFrame:
    """SNK-01: write a mart as parquet and return a DataFrame reading it back
    (cuts lineage: downstream jobs rescan the table, not the whole DAG)."""
    spark = df.sparkSession
    target = path or warehouse_path(spark, name)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return spark.read.parquet(target)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """SNK-01 for view models: a temp view, inlined into every consumer's plan."""
    df.createOrReplaceTempView(name)
    return df


def allowlisted(df: DataFrame, allowed: list[str]) -> DataFrame:
    """SNK-02: keep only allowlisted columns (case-insensitive)."""
    allow = {a.lower() for a in allowed}
    return df.select(*[c for c in df.columns if c.lower() in allow])


class ForbiddenColumnError(ValueError):
    pass


def assert_no_forbidden(df: DataFrame, label: str = "export") -> DataFrame:
    """SNK-03: refuse to export a column that looks like narrative / tags /
    zip / dispute data (has_narrative is the documented exception)."""
    bad = forbidden_columns(df.columns)
    if bad:
        raise ForbiddenColumnError(f"refusing to export {label}: forbidden column(s) {bad}")
    return df


def export_meta(cases: DataFrame, metrics: DataFrame, source_total: DataFrame, version: str,
                lag_days: int, window_days: int, retrieval_date: dt.date | None = None) -> DataFrame:
    """SNK-04: one-row export metadata (row counts are scalar subqueries)."""
    spark = cases.sparkSession
    return spark.range(1).select(
        F.lit(version).alias("export_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at_utc"),
        F.lit(lag_days).alias("publication_lag_window_days"),
        F.lit(window_days).alias("case_context_window_days"),
        cases.agg(F.count(F.lit(1))).scalar().alias("case_context_row_count"),
        metrics.agg(F.count(F.lit(1))).scalar().alias("metrics_row_count"),
        source_total.agg(F.count(F.lit(1))).scalar().alias("source_total_records"),
        F.lit(retrieval_date).cast("date").alias("source_retrieval_date"),
    )


def export_cases(cases: DataFrame) -> DataFrame:
    """SNK-02 + SNK-03 for the case-context export."""
    return assert_no_forbidden(allowlisted(cases, fixed.CASE_CONTEXT_ALLOWLIST), "agent_case_context")


def export_metrics(metrics: DataFrame) -> DataFrame:
    return assert_no_forbidden(allowlisted(metrics, fixed.METRICS_ALLOWLIST), "operations_overview_metrics")


def write_exhibits(exhibits: dict[str, DataFrame], path: str) -> None:
    """SNK-05: aggregate exhibits as JSON documents, one folder each.  Only
    small aggregates are coalesced to one file; record-level marts stay
    parquet (use `materialise`)."""
    for name, df in exhibits.items():
        df.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
