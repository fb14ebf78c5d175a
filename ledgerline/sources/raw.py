"""Raw ingest (SRC-01..SRC-10).

Spark's multi-line CSV reader takes a file in one task (a record may span
lines), so its parallelism comes from the number of files: land the archive as
many row-aligned chunks (`write_chunks`) and read the directory.  An archive that
is one large file is read by many tasks with `read_raw_split`.
Every column lands as a string; malformed rows are kept in `_corrupt` and
reported, never silently dropped.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import fixed
from ledgerline.sources.sinks import staged
from ledgerline.sources.split_csv import first_line, header_names, split_records
from ledgerline.sources.store import AlreadyThere, Store

CORRUPT = "_corrupt"
RAW_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in fixed.RAW_COLUMNS])
HEADER_SCHEMA_WITH_CORRUPT = T.StructType([T.StructField(h, T.StringType(), True) for _, h in fixed.RAW_COLUMNS]
                                          + [T.StructField(CORRUPT, T.StringType(), True)])
RAW_SCHEMA_WITH_CORRUPT = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-01 + SRC-03: '"' quote and escape, embedded newlines, empty -> NULL,
    gzip by extension, explicit all-string schema (never inferred); rows with
    the wrong column count land in `_corrupt`.  Every file's header is checked
    against the contract as the file is read: a missing, added or reordered
    column stops the load instead of shifting values."""
    parsed = (spark.read.schema(HEADER_SCHEMA_WITH_CORRUPT)
            .option("header", True).option("enforceSchema", False).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("encoding", "UTF-8")
            .csv(path))
    return parsed.select(*[F.col(f"`{h}`").alias(n) for n, h in fixed.RAW_COLUMNS], CORRUPT, "_metadata")


def read_raw_split(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`read_raw` for large files, uncompressed or block-gzipped (`.bgz`): the same rows,
    each file read by as many tasks as it has blocks."""
    fields = ", ".join([f"{n} string" for n, _ in fixed.RAW_COLUMNS] + [f"{CORRUPT} string"])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    records = split_records(spark, path)
    names = header_names(F.col("text"))
    contract = F.array(*[F.lit(h.lower()) for _, h in fixed.RAW_COLUMNS])
    fits = F.transform(names, lambda x: F.lower(x)) == contract
    refused = F.raise_error(F.concat(F.lit("the header of "), F.col("file"), F.lit(" is not the contract's: "), F.array_join(names, ", "))).cast("boolean")
    rows = records.filter(F.when(F.col("first"), F.when(fits, False).otherwise(refused)).otherwise(True))
    parsed = rows.select(F.from_csv("text", F.lit(fields), options).alias("r"), F.struct(F.element_at(F.split("file", "/"), -1).alias("file_name")).alias("_metadata"))
    return parsed.select("r.*", "_metadata")


def with_lineage(df: DataFrame, source_url: str, retrieved_at: dt.datetime, snapshot: dt.date, run_id: str,
                 source_system: str = "CFPB") -> DataFrame:
    """SRC-02: load lineage per row; the file name comes from the scan's
    `_metadata` column, so apply this directly on a file read."""
    out = df.withColumns({
        "source_system": F.lit(source_system),
        "source_url": F.lit(source_url),
        # wall-clock text -> timestamp_ntz: independent of session / process time zones
        "source_retrieved_at": F.lit(retrieved_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"),
        "source_file_name": F.col("_metadata.file_name"),
        "source_snapshot_date": F.lit(snapshot).cast("date"),
        "loaded_at": F.current_timestamp().cast("timestamp_ntz"),
        "load_run_id": F.lit(run_id),
    })
    return out.drop("_metadata")


def rejects(df: DataFrame) -> DataFrame:
    """SRC-03: rows the parser could not fit to the contract (with the id the
    parser salvaged, which also keeps a data column in the scan: Spark refuses
    raw-file queries that read only the corrupt-record column)."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(
        F.col("source_file_name").alias("file") if "source_file_name" in df.columns
        else F.col("_metadata.file_name").alias("file"),
        F.col(CORRUPT).alias("raw_line"), "complaint_id")


def landed_count(df: DataFrame) -> Column:
    """Row count of a landed raw table."""
    return F.count(F.lit(1))


def load_run(spark: SparkSession, csv_path: str | list[str], raw_table: str, run_id: str, source_url: str,
             retrieved_at: dt.datetime, snapshot: dt.date, source_system: str = "CFPB", read=read_raw) -> DataFrame:
    """SRC-01..03 + SRC-09 as one load: parse the CSV chunks, stamp lineage,
    append the run (rejects included, in `_corrupt`) to the all-string raw
    table, and return that run read back from the table.  Counting and reject
    reporting then run on parquet: Spark does not allow a raw CSV query that
    needs only the corrupt-record column.  `read`: `read_raw`, or `read_raw_split`
    for large files.  A file whose header is not the contract's refuses the load."""
    if run_id in loaded_runs(spark, raw_table):
        raise LoadRefused(f"load run {run_id!r} is already in {raw_table}")
    parsed = with_lineage(read(spark, csv_path), source_url, retrieved_at, snapshot, run_id, source_system)
    try:
        append_run(parsed, raw_table, run_id)
    except (PySparkException, Py4JError) as e:     # which file, and how its header differs
        differ = header_differences(spark, csv_path, str(e))
        if not differ:
            raise
        found = "; ".join(f"{r['file_name']}: {r['column']} {r['state']}" for r in differ)
        raise LoadRefused(f"header differs from the contract: {found}") from e
    return read_runs(spark, raw_table, [run_id])


def accepted_rows(df: DataFrame) -> DataFrame:
    """Rows that parsed, without the corrupt-record column."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def load_verification(raw: DataFrame, run_id: str | None = None) -> DataFrame:
    """SRC-04: counts for one run; duplicates exclude NULL ids.  Ids are counted as
    bitmaps, the plain counts are one row a task."""
    from ledgerline.operators.bitmaps import id_counts
    r = raw if run_id is None else raw.filter(F.col("load_run_id") == run_id)
    cid = F.nullif(F.trim("complaint_id"), F.lit(""))
    ids = id_counts(r.select(cid.alias("id")), "id")
    plain = r.agg(landed_count(r).alias("row_count"), F.count_if(cid.isNull()).alias("null_ids"),
                  F.min(F.try_to_date("date_received")).alias("min_date"),
                  F.max(F.try_to_date("date_received")).alias("max_date"))
    one = F.lit(1)
    return (plain.withColumn("one", one).join(ids.withColumn("one", one), "one")
            .select("row_count", "distinct_ids", "duplicate_ids", "null_ids", "min_date", "max_date"))


def header_diff(spark: SparkSession, actual: list[str], expected: list[str] | None = None) -> DataFrame:
    """SRC-05 / SET-04: missing, added and reordered header names."""
    expected = expected if expected is not None else [h for _, h in fixed.RAW_COLUMNS]
    rows = [(c, "missing") for c in expected if c not in actual]
    rows += [(c, "added") for c in actual if c not in expected]
    common_a = [c for c in actual if c in expected]
    common_e = [c for c in expected if c in actual]
    rows += [(a, "reordered") for a, e in zip(common_a, common_e) if a != e]
    return spark.createDataFrame(rows, "column string, state string")


FILES_AT_ONCE = 64


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-05: file_name and header (array of names, however many) of every landed
    file, to explain a refused load.  Only the first line of a file is read: a limit
    on each file stops its scan there.  Many files go in groups of one job each."""
    files, out = spark.read.text(path).inputFiles(), None
    for at in range(0, len(files), FILES_AT_ONCE):
        group = _headers(spark, files[at:at + FILES_AT_ONCE])
        group = staged(group, "headers") if len(files) > FILES_AT_ONCE else group
        out = group if out is None else out.unionByName(group)
    return spark.createDataFrame([], "file_name string, header array<string>") if out is None else out


def _headers(spark: SparkSession, files: list[str]) -> DataFrame:
    lines = [first_line(spark, unquote(f)).select(F.lit(f).alias("file_name"), "value") for f in files]
    return reduce(DataFrame.unionByName, lines).select("file_name", header_names(F.col("value")).alias("header"))


def header_differences(spark: SparkSession, path: str | list[str], error: str = "", most: int = 5) -> list:
    """The first rows of the `header_report` that explains a refused load.  The files
    that the reader's `error` names come in the first group, and no group is read
    after one that differs, so a load of very many files is explained by one job."""
    files = spark.read.text(path).inputFiles()
    named = [f for f in files if f.rpartition("/")[2] in error or unquote(f).rpartition("/")[2] in error][:FILES_AT_ONCE]
    rest = [f for f in files if f not in set(named)]
    first = FILES_AT_ONCE - len(named)
    here = {f: i for i, f in enumerate(files)}
    groups = [sorted([*named, *rest[:first]], key=here.get), *(rest[at:at + FILES_AT_ONCE] for at in range(first, len(rest), FILES_AT_ONCE))]
    for group in groups:
        if group and (found := header_report(_headers(spark, group)).limit(most).collect()):
            return found
    return []


def header_report(headers: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """SRC-05 / SET-04 over all files: (file_name, column, state), state missing,
    added or reordered (out of place among the names both have)."""
    want = F.array(*[F.lit(x) for x in (expected or [h for _, h in fixed.RAW_COLUMNS])])
    have = F.col("header")
    both_have, both_want = F.filter(have, lambda x: F.array_contains(want, x)), F.filter(want, lambda x: F.array_contains(have, x))
    moved = F.transform(F.arrays_zip(both_have.alias("a"), both_want.alias("e")), lambda z: F.when(z["a"] != z["e"], z["a"]))
    state = lambda names, s: F.transform(names, lambda x: F.struct(x.alias("column"), F.lit(s).alias("state")))
    found = F.concat(state(F.array_except(want, have), "missing"), state(F.array_except(have, want), "added"),
                     state(F.filter(moved, lambda x: x.isNotNull()), "reordered"))
    return headers.select("file_name", F.explode(found).alias("f")).select("file_name", "f.column", "f.state")


def gate(checks: DataFrame) -> DataFrame:
    """SRC-06: pass the checks on if all passed, else refuse the load."""
    failed = [r["check"] for r in checks.filter(~F.col("passed")).select("check").collect()]      # one row for each check
    if failed:
        raise LoadRefused(f"load gates failed: {', '.join(failed)}")
    return checks


def reconcile_count(raw: DataFrame, declared, stale: bool = False, has_issue: bool = False) -> DataFrame:
    """SRC-06: landed count vs the publisher's declared count (an int or a
    scalar Column) + status flags."""
    n = raw.agg(landed_count(raw)).scalar()
    declared = declared if not isinstance(declared, int) else F.lit(declared)
    spark = raw.sparkSession
    base = spark.range(1)
    return (base.select(F.lit("row_count_matches_declared").alias("check"), (n == declared).alias("passed"),
                        declared.cast("bigint").alias("expected"), n.alias("actual"))
                .unionByName(base.select(F.lit("not_stale").alias("check"), F.lit(not stale).alias("passed"),
                                         F.lit(None).cast("bigint").alias("expected"),
                                         F.lit(None).cast("bigint").alias("actual")))
                .unionByName(base.select(F.lit("no_data_issue").alias("check"), F.lit(not has_issue).alias("passed"),
                                         F.lit(None).cast("bigint").alias("expected"),
                                         F.lit(None).cast("bigint").alias("actual"))))


def seeds(spark: SparkSession) -> dict[str, DataFrame]:
    """SRC-07: the three reference tables (fixed, tiny; broadcast-safe)."""
    thresholds = spark.createDataFrame(
        fixed.THRESHOLDS, "policy_id string, trend_grain string, current_window_days int, baseline_window_days int, "
        "min_current_volume int, min_baseline_volume int, minimum_pct_change double, publication_lag_window_days int, "
        "min_triggered_high_policies int, priority string, action string, reason_code string, signal_confidence string, "
        "human_review_required boolean")
    playbook = spark.createDataFrame(
        fixed.PLAYBOOK, "recommended_action string, meaning string, owner string, human_review_required boolean, "
                        "prohibited_use string")
    accepted = spark.createDataFrame([(f, v) for f, vs in fixed.ACCEPTED_VALUES.items() for v in vs],
                                     "field_name string, accepted_value string")
    return {"priority_policy_thresholds": thresholds, "resolution_action_playbook": playbook,
            "accepted_values": accepted}


def write_chunks(df: DataFrame, path: str, rows: int = 1_000_000, partitions: int | None = None) -> None:
    """SRC-08: row-aligned gzip CSV chunks of at most `rows` records, each
    with a header (one writer task per input partition)."""
    out = df.repartition(partitions) if partitions else df
    (out.write.mode("overwrite").option("maxRecordsPerFile", rows).option("header", True)
        .option("quote", '"').option("escape", '"').option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))


class LoadRefused(ValueError):
    """A load that must not go on: a run id already loaded, or a gate that failed."""


RAW = "raw"


def loaded_runs(spark: SparkSession, path: str) -> list[str]:
    """load_run_id of every run in the raw table: the keys in its manifest."""
    return Store(spark, path).keys(RAW)


def read_runs(spark: SparkSession, path: str, runs: list[str] | None = None) -> DataFrame:
    """The raw table, or these runs of it; only their files are listed."""
    return Store(spark, path).read(RAW, keys=runs)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """SRC-09: append a load run.  The run's files are written beside the table and
    join it in one commit, so a load that fails leaves nothing in it, and of two
    loads of one run id, even at once, the second is refused (appending it again
    would double its rows)."""
    store = Store(df.sparkSession, path)
    try:
        store.append(RAW, store.write(df, run_id))
    except AlreadyThere:
        raise LoadRefused(f"load run {run_id!r} is already in {path}") from None


def latest_run(raw: DataFrame) -> DataFrame:
    """SRC-09: rows of the most recent run (by loaded_at), via a scalar subquery."""
    newest = raw.agg(F.max_by("load_run_id", "loaded_at")).scalar()
    return raw.filter(F.col("load_run_id") == newest)


def scan(spark: SparkSession, path: str, cols: list[str], date_col: str | None = None,
         since: dt.date | None = None) -> DataFrame:
    """SRC-10: projected (and optionally date-filtered) mart scan; both reach
    the parquet reader as ReadSchema / PushedFilters."""
    df = spark.read.parquet(path).select(*cols)
    return df.filter(F.col(date_col) >= F.lit(since)) if date_col and since else df
