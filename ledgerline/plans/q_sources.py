"""Ingest / sink queries: the orders fixture is landed as gzip CSV chunks
in a fresh folder under the session's checkpoint directory and read back
through the raw contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.params import ORDERS_PARAMS as P
from ledgerline.plans.oracle import orders_sql
from ledgerline.plans.pipeline import ArchivePipeline, Pipeline
from ledgerline.plans.registry import register
from ledgerline.session import scratch_path
from ledgerline.sources import raw as rw
from ledgerline.sources import sinks
from ledgerline.sources.split_csv import write_one_file

RAW_NAMES = [n for n, _ in fixed.RAW_COLUMNS]
CHUNK_ROWS = 4000      # several chunks even on the smallest table; the library's default is a million
RETRIEVED = dt.datetime(2001, 8, 1, 6, 0, 0)
URL = "https://example.invalid/complaints.csv.zip"


def _scratch(spark, what: str) -> str:
    return scratch_path(spark, what)


def land_orders(spark, sf: str, headers: bool = True) -> str:
    """Land the orders fixture as publisher-style CSV chunks (SRC-08)."""
    src = Pipeline.orders(spark, sf).raw.select(*RAW_NAMES)
    if headers:
        src = src.toDF(*[h for _, h in fixed.RAW_COLUMNS])
    path = _scratch(spark, "raw")
    rw.write_chunks(src, path, rows=CHUNK_ROWS)
    return path


def read_landed(spark, sf: str, run_id: str = "run-1"):
    """CSV chunks -> parsed -> appended to a raw parquet table -> this run."""
    path = land_orders(spark, sf)
    return rw.load_run(spark, path, path + "-raw", run_id, URL, RETRIEVED, P.snapshot_date)


RAW_NULLED = ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_NAMES)


@register("csv_roundtrip", lambda: orders_sql(f"SELECT {RAW_NULLED}, true AS has_file FROM raw_cases"),
          ids="SRC-01 SRC-02 SRC-08")
def q_roundtrip(spark, sf):
    r = read_landed(spark, sf)
    return rw.accepted_rows(r).select(*RAW_NAMES, F.col("source_file_name").isNotNull().alias("has_file"))


# A long narrative of several quoted lines, by rule: it has line breaks, quotes, commas and an empty line.
NARRATIVE = """concat('He said "no", twice:', chr(10), chr(10), repeat(concat('order ', complaint_id, ', "again"', chr(10)),
  CAST(20 + CAST(complaint_id AS bigint) % 40 AS integer)), 'end of ', complaint_id)"""


@register("csv_one_file", lambda: orders_sql(
    f"SELECT {', '.join(c for c in RAW_NULLED.split(', ') if 'narrative' not in c)}, md5({NARRATIVE}) AS narrative_md5, "
    f"length({NARRATIVE}) AS narrative_length, 1 AS files FROM raw_cases"), ids="SRC-01 SRC-08 (one file, many tasks)")
def q_one_file(spark, sf):
    """All records as one CSV file with quoted line breaks, block-gzipped, read by as many
    tasks as it has blocks, through a load into the raw table."""
    src = Pipeline.orders(spark, sf).raw.select(*RAW_NAMES).withColumn("consumer_complaint_narrative", F.expr(NARRATIVE))
    path = _scratch(spark, "one-file")
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    write_one_file(src.select(F.to_csv(F.struct(*RAW_NAMES), options).alias("value")), path, ",".join(h for _, h in fixed.RAW_COLUMNS))
    loaded = rw.load_run(spark, path, path + "-raw", "run-1", URL, RETRIEVED, P.snapshot_date, read=rw.read_raw_split)
    rows = rw.accepted_rows(loaded)
    files = rows.agg(F.count_distinct("source_file_name")).scalar()
    text = F.col("consumer_complaint_narrative")
    return rows.select(*[c for c in RAW_NAMES if "narrative" not in c], F.md5(text).alias("narrative_md5"), F.length(text).alias("narrative_length"),
                       files.alias("files"))


BAD_EVERY = 997   # landing rule: every 997th order gets a 17th field


def land_with_long_rows(spark, sf: str) -> str:
    """CSV lines under the contract's header, written as text: every chunk starts
    with the header, every BAD_EVERY-th record has one field more."""
    src = Pipeline.orders(spark, sf).raw.select(*RAW_NAMES)
    line = F.to_csv(F.struct(*RAW_NAMES), {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                                           "ignoreTrailingWhiteSpace": "false"})
    line = F.when(F.col("complaint_id").cast("bigint") % BAD_EVERY == 0, F.concat(line, F.lit(",x"))).otherwise(line)
    header = ",".join(h for _, h in fixed.RAW_COLUMNS)

    def headed(batches):
        import pyarrow as pa
        yield pa.record_batch({"value": pa.array([header], pa.string())})
        yield from batches

    base = _scratch(spark, "mixed")
    src.select(line.alias("value")).mapInArrow(headed, "value string").write.text(f"{base}/raw")
    return base


@register("csv_rejects", lambda: orders_sql(
    f"SELECT count_if(o_orderkey % {BAD_EVERY} = 0) AS rejected, count_if(o_orderkey % {BAD_EVERY} <> 0) "
    f"AS accepted, count_if(o_orderkey % {BAD_EVERY} = 0) AS files_named FROM orders"),
    ids="SRC-03")
def q_rejects(spark, sf):
    """Land rows of which some carry a field too many; every one must be
    reported, none dropped silently."""
    base = land_with_long_rows(spark, sf)
    r = rw.load_run(spark, f"{base}/raw", f"{base}/raw_table", "run-1", URL, RETRIEVED,
                    P.snapshot_date)
    bad_row = F.col(rw.CORRUPT).isNotNull()
    return r.agg(F.count_if(bad_row).alias("rejected"), F.count_if(~bad_row).alias("accepted"),
                 F.count_if(bad_row & F.col("source_file_name").isNotNull()).alias("files_named"))


@register("load_verification", lambda: orders_sql(
    "SELECT count(*) AS row_count, count(DISTINCT nullif(trim(complaint_id), '')) AS distinct_ids, "
    "count(nullif(trim(complaint_id), '')) - count(DISTINCT nullif(trim(complaint_id), '')) AS duplicate_ids, "
    "count_if(nullif(trim(complaint_id), '') IS NULL) AS null_ids, "
    "min(try_cast(date_received AS date)) AS min_date, max(try_cast(date_received AS date)) AS max_date "
    "FROM raw_cases"), ids="SRC-04")
def q_load_verification(spark, sf):
    return rw.load_verification(rw.accepted_rows(read_landed(spark, sf)), "run-1")


HEADERS_SQL = """
SELECT f.file, f.column, f.state, (SELECT count(*) FROM raw_cases) AS records FROM (VALUES
  ('reordered', 'Issue', 'reordered'), ('reordered', 'Product', 'reordered'),
  ('short', 'Tags', 'missing'), ('long', 'Extra', 'added')) f("file", "column", state)
"""


def _reordered(names: list[str]) -> list[str]:
    swap = {"Product": "Issue", "Issue": "Product"}
    return [swap.get(n, n) for n in names]


@register("header_contract", lambda: orders_sql(HEADERS_SQL), ids="SRC-05 SET-04")
def q_header(spark, sf):
    """Land the records four times: as the contract has it, with two columns
    swapped, without one and with one more; report every file that differs."""
    src = Pipeline.orders(spark, sf).raw.select(*RAW_NAMES).toDF(*[h for _, h in fixed.RAW_COLUMNS])
    base = _scratch(spark, "headers")
    kinds = {"good": src, "reordered": src.select(*[F.col(f"`{c}`") for c in _reordered(src.columns)]),
             "short": src.drop("Tags"), "long": src.withColumn("Extra", F.lit("x"))}
    for kind, df in kinds.items():
        rw.write_chunks(df, f"{base}/{kind}", rows=1_000_000)
    headers = rw.file_headers(spark, [f"{base}/{k}" for k in kinds])
    kind = F.regexp_extract("file_name", r"/(\w+)/[^/]+$", 1)
    report = rw.header_report(headers).select(kind.alias("file"), "column", "state").distinct()
    return report.withColumn("records", src.agg(F.count(F.lit(1))).scalar())


@register("drifted_load_refused", lambda: orders_sql(
    "SELECT k.kind, k.refused, if(k.refused, 0, (SELECT count(*) FROM raw_cases)) AS loaded FROM (VALUES ('good', false), "
    "('reordered', true), ('short', true)) k(kind, refused)"), ids="SRC-01 SRC-05 (load gate)")
def q_drift_refused(spark, sf):
    """A load of a drifted file stops; nothing of it reaches the raw table."""
    src = Pipeline.orders(spark, sf).raw.select(*RAW_NAMES).toDF(*[h for _, h in fixed.RAW_COLUMNS])
    base, out = _scratch(spark, "drift"), None
    kinds = {"good": src, "reordered": src.select(*[F.col(f"`{c}`") for c in _reordered(src.columns)]), "short": src.drop("Tags")}
    for kind, df in kinds.items():
        rw.write_chunks(df, f"{base}/{kind}", rows=CHUNK_ROWS)
        try:
            n = rw.load_run(spark, f"{base}/{kind}", f"{base}/{kind}-raw", "run-1", URL, RETRIEVED, P.snapshot_date).agg(F.count(F.lit(1)).alias("loaded"))
            row = n.select(F.lit(kind).alias("kind"), F.lit(False).alias("refused"), "loaded")
        except rw.LoadRefused:
            row = spark.range(1).select(F.lit(kind).alias("kind"), F.lit(True).alias("refused"), F.lit(0).cast("long").alias("loaded"))
        out = row if out is None else out.unionByName(row)
    return out


@register("duplicate_run_refused", lambda: orders_sql(
    "SELECT 'run-1' AS load_run_id, true AS refused, count(*) AS n FROM raw_cases"), ids="SRC-09 (duplicate run)")
def q_duplicate_run(spark, sf):
    """The same run id a second time is refused, and the table keeps its rows once."""
    path, landed, refused = _scratch(spark, "runs"), land_orders(spark, sf), False
    rw.load_run(spark, landed, path, "run-1", URL, RETRIEVED, P.snapshot_date)
    try:
        rw.load_run(spark, landed, path, "run-1", URL, RETRIEVED, P.snapshot_date)
    except rw.LoadRefused:
        refused = True
    return (rw.read_runs(spark, path).groupBy("load_run_id").agg(F.count(F.lit(1)).alias("n"))
            .select("load_run_id", F.lit(refused).alias("refused"), "n"))


@register("count_reconciliation", lambda: orders_sql(
    "SELECT 'row_count_matches_declared' AS \"check\", true AS passed, (SELECT count(*) FROM orders) AS expected, "
    "(SELECT count(*) FROM raw_cases) AS actual UNION ALL SELECT 'not_stale', true, NULL, NULL "
    "UNION ALL SELECT 'no_data_issue', true, NULL, NULL "
    "UNION ALL SELECT 'mismatched_declared_count', false, (SELECT count(*) + 1 FROM orders), (SELECT count(*) FROM raw_cases)"), ids="SRC-06")
def q_reconcile_count(spark, sf):
    declared = spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet").agg(F.count(F.lit(1))).scalar()
    landed = rw.accepted_rows(read_landed(spark, sf))
    wrong = rw.reconcile_count(landed, declared + 1).filter(F.col("check") == "row_count_matches_declared")
    checks = rw.gate(rw.reconcile_count(landed, declared))
    return checks.unionByName(wrong.withColumn("check", F.lit("mismatched_declared_count")))


@register("latest_run_rows", lambda: orders_sql(
    "SELECT 'run-2' AS load_run_id, count(*) AS n FROM raw_cases"), ids="SRC-09")
def q_latest_run(spark, sf):
    path = _scratch(spark, "runs")
    landed = land_orders(spark, sf)
    for run in ("run-1", "run-2"):
        rw.load_run(spark, landed, path, run, URL, RETRIEVED, P.snapshot_date)
    runs = rw.read_runs(spark, path)
    return rw.latest_run(runs).groupBy("load_run_id").agg(F.count(F.lit(1)).alias("n"))


@register("staged_from_csv", lambda: orders_sql(
    "SELECT complaint_id, complaint_received_date, product, issue, company_response, timely_response_status, "
    "recent_publication_lag_flag FROM stg"), ids="SRC-01..PRJ-07 end to end")
def q_staged_from_csv(spark, sf):
    r = rw.accepted_rows(read_landed(spark, sf))
    pl = Pipeline(r, P)
    return pl.staged.select("complaint_id", "complaint_received_date", "product", "issue", "company_response",
                            "timely_response_status", "recent_publication_lag_flag")


SCAN_SINCE = dt.date(2001, 1, 1)


@register("mart_scan", lambda: orders_sql(
    f"SELECT metric_date, product, issue, daily_complaint_count FROM fdm WHERE metric_date >= DATE '{SCAN_SINCE}'"),
    ids="SRC-10 SNK-01")
def q_mart_scan(spark, sf):
    pl = Pipeline.orders(spark, sf)
    path = _scratch(spark, "fdm")
    sinks.materialise(pl.fdm, "fdm", path=path)
    return rw.scan(spark, path, ["metric_date", "product", "issue", "daily_complaint_count"], "metric_date",
                   SCAN_SINCE)


@register("export_meta", lambda: orders_sql(
    "SELECT 'v1' AS export_version, 60 AS publication_lag_window_days, 180 AS case_context_window_days, "
    "(SELECT count(*) FROM cases WHERE complaint_received_date >= DATE '2001-08-01' - INTERVAL 180 DAY "
    "AND complaint_received_date < DATE '2001-08-01' - INTERVAL 60 DAY) AS case_context_row_count, "
    "(SELECT count(*) FROM fdm) AS metrics_row_count, (SELECT count(*) FROM raw_cases) AS source_total_records, "
    "DATE '2001-08-01' AS source_retrieval_date"), ids="SNK-04 SNK-02 SNK-03")
def q_export_meta(spark, sf):
    from ledgerline.operators.exhibits import current_window
    pl = ArchivePipeline.orders(spark, sf)
    cases = sinks.export_cases(current_window(pl.cases, P.as_of, P.case_window_days, P.lag_days))
    metrics = sinks.export_metrics(pl.fdm.select("metric_date", F.col("product").alias("dashboard_dimension"),
                                                 F.lit("complaint_volume").alias("metric_name"),
                                                 F.col("daily_complaint_count").alias("metric_value")))
    meta = sinks.export_meta(cases, metrics, pl.raw, "v1", P.lag_days, P.case_window_days, P.as_of)
    return meta.drop("generated_at_utc").withColumn("publication_lag_window_days",
                                                    F.col("publication_lag_window_days").cast("int")) \
               .withColumn("case_context_window_days", F.col("case_context_window_days").cast("int"))


@register("streamed_staging", lambda: orders_sql(
    "SELECT complaint_id, complaint_received_date, product, issue, sub_product, company_response, "
    "timely_response_status, recent_publication_lag_flag, data_completeness_status FROM ctx"),
    ids="streaming landing (SRC-01..PRJ-08 on a file stream)")
def q_streamed(spark, sf):
    """Land the fixture as CSV chunks, run the landing stream to completion
    (availableNow) into a parquet table, and read that table back."""
    from ledgerline.streaming.landing import start_landing
    landed = land_orders(spark, sf)
    out, ckpt = _scratch(spark, "stream-out"), _scratch(spark, "stream-ckpt")
    q = start_landing(spark, landed, out, ckpt, P, URL, RETRIEVED, "run-1")
    q.awaitTermination()
    return spark.read.parquet(out).select(
        "complaint_id", "complaint_received_date", "product", "issue", "sub_product", "company_response",
        "timely_response_status", "recent_publication_lag_flag", "data_completeness_status")


@register("streamed_rejects", lambda: orders_sql(
    f"SELECT 'rejected' AS sink, count(*) AS n FROM orders WHERE o_orderkey % {BAD_EVERY} = 0 UNION ALL "
    f"SELECT 'accepted', count(*) FROM orders WHERE o_orderkey % {BAD_EVERY} <> 0"),
    ids="SRC-03 (streaming: rejects go to a sink of their own)")
def q_streamed_rejects(spark, sf):
    """Both sinks of the landing stream over files with long rows: every landed row is in one of them."""
    from ledgerline.streaming.landing import start_rejects
    base = land_with_long_rows(spark, sf)
    out = f"{base}/rejects"
    start_rejects(spark, f"{base}/raw", out, f"{base}/ckpt", P, URL, RETRIEVED, "run-1").awaitTermination()
    ok = rw.load_run(spark, f"{base}/raw", f"{base}/table", "run-1", URL, RETRIEVED, P.snapshot_date)
    return (spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("sink"), "n")
            .unionByName(rw.accepted_rows(ok).agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("sink"), "n")))
