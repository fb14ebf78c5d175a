"""Data-quality operators (DQ-A..DQ-V).

Checks return failing rows (0 rows = pass) unless they are profiles.
Multi-column checks are one pass: a single aggregate with one conditional
count per column, unpivoted with `stack`, rather than one job per column.
"""

from __future__ import annotations

import datetime as dt
import uuid
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import masked_zip
from ledgerline.params import Params

# FIXED VALUES: documented baseline null rates (percent) of the raw source.
NULL_RATE_BASELINE_PCT = {
    "sub_product": 1.374,
    "sub_issue": 5.418,
    "consumer_complaint_narrative": 77.586,
    "company_public_response": 45.409,
    "state": 0.364,
    "tags": 95.375,
}
DRIFT_WARN_THRESHOLD_PCT = 5.0
ZIP_MASK_BAND_PCT = (1.0, 25.0)


def _stack(pairs: list[tuple[str, str]], key: str, value: str) -> str:
    body = ", ".join(f"'{k}', `{v}`" for k, v in pairs)
    return f"stack({len(pairs)}, {body}) AS ({key}, {value})"


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-A profile: (column, null_count) for every column, one pass."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(cols)]
    return df.agg(*aggs).selectExpr(_stack([(c, f"n_{i}") for i, c in enumerate(cols)], "column_name",
                                           "null_count"))


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-A: failing columns."""
    return null_counts(df, cols).filter(F.col("null_count") > 0)


def unique(df: DataFrame, key: str) -> DataFrame:
    """DQ-B: duplicated non-null keys (map-side partial count, then filter)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def unique_combo(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-E: duplicated key combinations."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def accepted(df: DataFrame, col: str, domain: list[str] | None = None, severity: str = "error") -> DataFrame:
    """DQ-C: values outside the closed domain (NULLs are a not_null concern)."""
    domain = domain if domain is not None else fixed.ACCEPTED_VALUES[col]
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(domain))
              .groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(col).alias("column_name"), "value", "n", F.lit(severity).alias("severity")))


def stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_all(keys: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """DQ-B over (table name, frame, key): duplicated keys of all tables.  Numeric
    ids are shuffled as bitmaps, and only blocks that hold a repeated one as ids."""
    from ledgerline.operators.bitmaps import repeated_ids
    from ledgerline.sources.sinks import staged
    rows = stacked([df.select(F.lit(t).alias("table_name"), F.col(k).cast("string").alias("id")) for t, df, k in keys])
    return repeated_ids(staged(rows, "unique-keys"), "id", ["table_name"])


def accepted_all(df: DataFrame, checks: list[tuple[str, str, list[str]]]) -> DataFrame:
    """DQ-C over (column, severity, domain) of one table in one pass: only values
    outside their domain leave the row, already named."""
    odd = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(domain),
                  F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), F.lit(sev).alias("severity")))
           for c, sev, domain in checks]
    found = df.select(F.explode(F.filter(F.array(*odd), lambda x: x.isNotNull())).alias("x")).select("x.*")
    return found.groupBy("column_name", "value", "severity").agg(F.count(F.lit(1)).alias("n")).select("column_name", "value", "n", "severity")


def relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """DQ-D / JN-14: child keys with no parent."""
    return child.select(key).join(parent.select(key), key, "left_anti")


def reconcile_rollups(fdm: DataFrame, rec: DataFrame) -> DataFrame:
    """AG-35 + JN-07: summed daily counts vs actual record counts per
    (product, issue), full outer join with coalesced keys."""
    a = fdm.groupBy("product", "issue").agg(F.sum("daily_complaint_count").alias("summed_daily_count"))
    b = (rec.filter(F.col("product").isNotNull() & F.col("issue").isNotNull())
            .groupBy("product", "issue").agg(F.count(F.lit(1)).alias("actual_complaint_count")))
    j = a.alias("d").join(b.alias("t"), (F.col("d.product") == F.col("t.product"))
                          & (F.col("d.issue") == F.col("t.issue")), "full")
    return j.select(F.coalesce("d.product", "t.product").alias("product"),
                    F.coalesce("d.issue", "t.issue").alias("issue"),
                    "summed_daily_count", "actual_complaint_count")


def daily_reconciles(fdm: DataFrame, rec: DataFrame) -> DataFrame:
    """DQ-F: failing (product, issue) pairs."""
    r = reconcile_rollups(fdm, rec)
    return r.filter(~F.col("summed_daily_count").eqNullSafe(F.col("actual_complaint_count")))


def dropped_rows(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """JN-08: raw minus staged row count as one row (two scalar subqueries)."""
    spark = raw.sparkSession
    return spark.range(1).select(
        (raw.agg(F.count(F.lit(1))).scalar() - staged.agg(F.count(F.lit(1))).scalar()).alias("dropped_row_count"))


def dropped_bounded(raw: DataFrame, staged: DataFrame, ceiling: int = 100) -> DataFrame:
    """DQ-G: fails when the drop count is negative or above the ceiling."""
    d = dropped_rows(raw, staged)
    return d.filter((F.col("dropped_row_count") > ceiling) | (F.col("dropped_row_count") < 0))


def critical_without_trigger(queue: DataFrame) -> DataFrame:
    """DQ-H."""
    return queue.filter((F.col("priority") == "CRITICAL") & (
        ~F.coalesce(F.array_contains("policy_ids", "POLICY_CRITICAL_COMBINATION"), F.lit(False))
        | (F.col("data_completeness_status") != "COMPLETE") | (F.col("recent_publication_lag_flag") == True)))  # noqa: E712


def reason_required(queue: DataFrame) -> DataFrame:
    """DQ-I: non-standard actions carry reasons, policies, evidence, confidence."""
    empty = lambda c: F.col(c).isNull() | (F.size(c) == 0)
    # The lag flag and the completeness are always set, so they are no evidence by themselves.
    fields = [f for f in queue.schema["evidence_fields"].dataType.names if f not in ("recent_publication_lag_flag", "data_completeness_status")]
    no_evidence = F.coalesce(*[F.col("evidence_fields")[f].cast("string") for f in fields]).isNull()
    return queue.filter((F.col("recommended_action") != "STANDARD_HANDLING") & (
        empty("reason_codes") | empty("policy_ids") | no_evidence
        | F.col("signal_confidence").isNull()))


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name) for the given marts (schema metadata only)."""
    rows = [(t, c) for t, df in tables.items() for c in df.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def duration_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """DQ-J (+ FN-17): columns whose name claims a response duration."""
    cat = column_catalog(spark, tables)
    cond = None
    for pat in fixed.DURATION_PATTERNS:
        e = F.col("column_name").ilike(f"%{pat}%")
        cond = e if cond is None else cond | e
    return cat.filter(cond)


# FIXED VALUES: raw fields whose value distribution is profiled (top 25 each).
TOP_VALUE_FIELDS = ["product", "company_response_to_consumer", "timely_response", "submitted_via", "tags"]


def top_values(raw: DataFrame, fields: list[str] = TOP_VALUE_FIELDS, k: int = 25) -> DataFrame:
    """TK-05: the k most frequent non-empty values per field.  The unpivot is
    pipelined into a partial aggregate, so only (field, value) counts are
    shuffled; the per-field limit runs as a window group limit."""
    from pyspark.sql import Window
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    long = raw.selectExpr(f"stack({len(fields)}, {pairs}) AS (field, value)").filter(
        F.col("value").isNotNull() & (F.col("value") != ""))
    counts = long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("field").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def run_checks(checks: list[tuple[str, str, DataFrame]], store_root: str | None = None) -> DataFrame:
    """DQ-K: (check, severity, failures, status) for (name, severity,
    failing-rows frame) triples.  With `store_root`, each check's failing
    rows are stored as a parquet table (`store_root/<name>`) and the failure
    count is observed during that write, so the rows are computed once."""
    from pyspark.sql import Observation
    out = None
    spark = checks[0][2].sparkSession
    for name, severity, df in checks:
        if store_root is None:
            one = df.agg(F.count(F.lit(1)).alias("failures"))
        else:
            obs = Observation(f"dq_{name}_{uuid.uuid4().hex}")
            df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
                f"{store_root.rstrip('/')}/{name}")
            one = spark.range(1).select(F.lit(obs.get["n"]).cast("bigint").alias("failures"))
        one = one.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass")
                          .when(F.col("severity") == "warn", "warn").otherwise("error"))


def freshness(df: DataFrame, as_of: dt.date, col: str = "loaded_at", warn_days: int = 3,
              error_days: int = 14) -> DataFrame:
    """DQ-L: age of the newest load against `as_of`."""
    latest = df.agg(F.max(F.col(col).cast("date")).alias("latest"))
    age = F.datediff(F.lit(as_of), F.col("latest"))
    return (latest.withColumn("age_days", age)
                  .withColumn("status", F.when(F.col("latest").isNull() | (age > error_days), "error")
                              .when(age > warn_days, "warn").otherwise("pass")))


RAW_NAMES = [n for n, _ in fixed.RAW_COLUMNS]


def _blank(c: str):
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def profile(raw: DataFrame) -> DataFrame:
    """DQ-M: rows, unique / duplicate / null ids, date range, per-field null
    counts and rates; one aggregate, unpivoted to (metric, value) rows."""
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.countDistinct(F.when(~_blank("complaint_id"), F.col("complaint_id"))).alias("unique_ids"),
            F.min(F.when(~_blank("date_received"), F.col("date_received"))).alias("date_received_min"),
            F.max(F.when(~_blank("date_received"), F.col("date_received"))).alias("date_received_max")]
    aggs += [F.count_if(_blank(c)).alias(f"null__{c}") for c in RAW_NAMES]
    a = raw.agg(*aggs)
    a = a.withColumn("duplicate_ids", F.col("total_rows") - F.col("null__complaint_id") - F.col("unique_ids"))
    metrics = [("total_rows", "total_rows"), ("unique_ids", "unique_ids"), ("duplicate_ids", "duplicate_ids")]
    metrics += [(f"null_count:{c}", f"null__{c}") for c in RAW_NAMES]
    counts = a.selectExpr(_stack(metrics, "metric", "value"), "total_rows AS _n",
                          "date_received_min", "date_received_max")
    return counts.select("metric", F.col("value").cast("bigint").alias("value"),
                         F.when(F.col("metric").startswith("null_count:"),
                                F.round((F.col("value") * 100.0 / F.col("_n")).cast("decimal(38,12)"), 4)
                                .cast("double")).alias("pct"),
                         "date_received_min", "date_received_max")


def profile_by_month(raw: DataFrame) -> DataFrame:
    """DQ-N: complaints and narratives per YYYY-MM."""
    return (raw.groupBy(F.substring("date_received", 1, 7).alias("month"))
               .agg(F.count(F.lit(1)).alias("complaints"),
                    F.count_if(~_blank("consumer_complaint_narrative")).alias("narratives")))


def profile_flags(raw: DataFrame) -> DataFrame:
    """DQ-O: masked-ZIP and in-progress counts and rates."""
    r = raw.agg(F.count(F.lit(1)).alias("n"),
                F.count_if(F.coalesce(masked_zip("zip_code"), F.lit(False))).alias("zip_masked_count"),
                F.count_if(F.col("company_response_to_consumer") == "In progress").alias("in_progress_count"))
    pct = lambda c: F.round((F.col(c) * 100.0 / F.col("n")).cast("decimal(38,12)"), 4).cast("double")
    return r.select("zip_masked_count", pct("zip_masked_count").alias("zip_masked_rate_pct"),
                    "in_progress_count", pct("in_progress_count").alias("in_progress_rate_pct"))


def drift(prof: DataFrame, flags: DataFrame, expected_min_date: str,
          baseline: dict[str, float] = NULL_RATE_BASELINE_PCT,
          threshold: float = DRIFT_WARN_THRESHOLD_PCT) -> DataFrame:
    """DQ-P: warnings for null-rate drift, ZIP-mask band, archive start date."""
    spark = prof.sparkSession
    base = spark.createDataFrame([(f"null_count:{k}", float(v)) for k, v in baseline.items()],
                                 "metric string, baseline_pct double")
    nulls = (prof.join(F.broadcast(base), "metric")
                 .withColumn("drift_pp", F.abs(F.col("pct") - F.col("baseline_pct")))
                 .filter(F.col("drift_pp") > threshold)
                 .select(F.lit("null_rate_drift").alias("check_name"),
                         F.regexp_replace("metric", "^null_count:", "").alias("subject"),
                         F.col("pct").alias("observed"), F.col("baseline_pct").alias("expected")))
    lo, hi = ZIP_MASK_BAND_PCT
    z = (flags.filter((F.col("zip_masked_rate_pct") < lo) | (F.col("zip_masked_rate_pct") > hi))
              .select(F.lit("zip_mask_band").alias("check_name"), F.lit("zip_code").alias("subject"),
                      F.col("zip_masked_rate_pct").alias("observed"), F.lit(None).cast("double").alias("expected")))
    d = (prof.filter(F.col("metric") == "total_rows")
             .filter(~F.col("date_received_min").eqNullSafe(F.lit(expected_min_date)))
             .select(F.lit("archive_start").alias("check_name"), F.col("date_received_min").alias("subject"),
                     F.lit(None).cast("double").alias("observed"), F.lit(None).cast("double").alias("expected")))
    return nulls.unionByName(z).unionByName(d)


def blocking(prof: DataFrame, raw_columns: list[str]) -> DataFrame:
    """DQ-Q: duplicate ids, null ids, a forbidden dispute field present."""
    bad = (prof.filter(((F.col("metric") == "duplicate_ids") | (F.col("metric") == "null_count:complaint_id"))
                       & (F.col("value") != 0))
               .select(F.col("metric").alias("check_name"), "value"))
    present = [c for c in raw_columns if "consumer_disputed" in c.lower()]
    if present:
        spark = prof.sparkSession
        bad = bad.unionByName(spark.createDataFrame([("consumer_disputed_present", len(present))],
                                                    "check_name string, value bigint"))
    return bad


def lag_by_recency(rec: DataFrame, as_of: dt.date) -> DataFrame:
    """DQ-R: share still 'In progress' by recency bucket."""
    age = F.datediff(F.lit(as_of), F.col("complaint_received_date"))
    ip = F.col("company_response") == "In progress"
    # a one-month slice about a year back (the measured window the source
    # report calls "~12 months prior")
    buckets = [("last_7_days", age <= 7), ("days_30_60", (age >= 30) & (age <= 60)),
               ("about_12_months_prior", (age >= 365) & (age <= 395)), ("all", F.lit(True))]
    aggs = []
    for i, (_, cond) in enumerate(buckets):
        aggs += [F.count_if(cond).alias(f"t{i}"), F.count_if(cond & F.coalesce(ip, F.lit(False))).alias(f"p{i}")]
    stacked = ", ".join(f"'{b}', t{i}, p{i}" for i, (b, _) in enumerate(buckets))
    out = rec.agg(*aggs).selectExpr(f"stack({len(buckets)}, {stacked}) AS (bucket, total, in_progress)")
    return out.withColumn("share", F.when(F.col("total") > 0, F.col("in_progress") / F.col("total")))


def domain_shares(rec: DataFrame, col: str) -> DataFrame:
    """DQ-S: observed value-domain shares."""
    per = rec.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum("n")).scalar()
    return per.withColumn("share", F.col("n") / total)


def concentration(rec: DataFrame, col: str = "product") -> DataFrame:
    """DQ-T: category concentration shares, ranked."""
    from ledgerline.operators.ranking import ranked
    return ranked(domain_shares(rec, col), [F.desc("n"), F.asc(col)])


def unknown_labels(rec: DataFrame, dim: DataFrame) -> DataFrame:
    """DQ-U: taxonomy combinations present in records but not in the dim."""
    cols = ["product", "sub_product", "issue", "sub_issue"]
    d = dim.select(*[F.col(c).alias("_" + c) for c in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col("_" + c))
        cond = e if cond is None else cond & e
    return rec.select(*cols).distinct().join(d, cond, "left_anti")


def parity(seed: DataFrame, p: Params) -> DataFrame:
    """DQ-V as a table: (parameter, configured, seeded) that differ from the seed's emerging-issue row."""
    spark = seed.sparkSession
    have = spark.createDataFrame([("current_window_days", float(p.cur)), ("baseline_window_days", float(p.base)),
                                  ("min_current_volume", float(p.min_cur)), ("min_baseline_volume", float(p.min_base)),
                                  ("minimum_pct_change", float(p.min_pct))], "parameter string, configured double")
    names = ["current_window_days", "baseline_window_days", "min_current_volume", "min_baseline_volume", "minimum_pct_change"]
    want = (seed.filter(F.col("policy_id") == fixed.TREND_POLICY_ID)
            .select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "parameter", "seeded"))
    return have.join(want, "parameter", "left").filter(~F.col("configured").eqNullSafe(F.col("seeded")))


def config_parity(p: Params, seed: dict[str, object]) -> list[tuple[str, object, object]]:
    """DQ-V: parameters that differ from the audited seed row (driver-side,
    compares two small configs; no data involved)."""
    pairs = [("current_window_days", p.cur), ("baseline_window_days", p.base),
             ("min_current_volume", p.min_cur), ("min_baseline_volume", p.min_base),
             ("minimum_pct_change", p.min_pct)]
    out = []
    for k, v in pairs:
        s = seed.get(k)
        if s is None or float(s) != float(v):
            out.append((k, v, s))
    return out
