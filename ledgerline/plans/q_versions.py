"""Snapshots that correct each other, trends kept up to date by deltas, and
atomic publication (SRC-09, SNK-01, AG-28, W-01..03)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ledgerline.operators import incremental, versions
from ledgerline.params import ORDERS_PARAMS as P
from ledgerline.plans import build
from ledgerline.plans.oracle import chain, orders_sql, snapshot_raw
from ledgerline.plans.pipeline import Pipeline
from ledgerline.plans.q_core import OPS_SQL, TREND_SQL, _case_out, _trend_out
from ledgerline.plans.q_exhibits import _sample_cols
from ledgerline.plans.q_sources import RAW_NAMES, RETRIEVED, URL, _scratch, land_orders
from ledgerline.plans.registry import register
from ledgerline.sources import raw as rw
from ledgerline.sources.fixtures import LATE_SNAPSHOTS, SNAPSHOTS, orders_snapshot
from ledgerline.sources.sinks import staged
from ledgerline.sources.store import Conflict, Store

DATES = [d for d, _, _ in SNAPSHOTS]
#: Days a reader looks back to: between, on and after the snapshots.
LOOKED_AT = [DATES[0], DATES[0].replace(day=20), DATES[1], DATES[2].replace(year=2002)]
SHOWN = ["complaint_id", "date_received", "issue", "company_response_to_consumer"]
SNAPSHOT_CTES = ", ".join(f"s{k} AS ({snapshot_raw(s)})" for k, s in enumerate(SNAPSHOTS))


def landed(spark, sf) -> tuple[versions.VersionedRecords, list]:
    """All snapshots folded into versioned records, and the changes of each."""
    records = versions.VersionedRecords(Store(spark, _scratch(spark, "versions")), ignore=("source_snapshot_date",))
    found = [records.apply_snapshot(staged(orders_snapshot(spark, sf, k).select(*RAW_NAMES), "snapshot"), date) for k, date in enumerate(DATES)]
    return records, found


def _changes_sql() -> str:
    """By set differences of whole rows, then what either side has of an id."""
    pairs = []
    for k in (1, 2):
        cols = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in sorted(RAW_NAMES))
        pairs.append(f"""
          SELECT DATE '{DATES[k]}' AS snapshot, complaint_id,
            CASE WHEN o.date_received IS NULL THEN 'added' WHEN n.date_received IS NULL THEN 'withdrawn' ELSE 'changed' END AS change,
            CASE WHEN o.date_received IS NOT NULL AND n.date_received IS NOT NULL THEN concat_ws('|', {cols}) END AS columns
          FROM (SELECT * EXCLUDE (source_snapshot_date) FROM s{k - 1} EXCEPT ALL SELECT * EXCLUDE (source_snapshot_date) FROM s{k}) o
          FULL JOIN (SELECT * EXCLUDE (source_snapshot_date) FROM s{k} EXCEPT ALL SELECT * EXCLUDE (source_snapshot_date) FROM s{k - 1}) n
          USING (complaint_id)""")
    return f"WITH {SNAPSHOT_CTES} " + " UNION ALL ".join(pairs)


@register("snapshot_changes", _changes_sql, ids="SRC-09 PRJ-06 (corrections between snapshots)")
def q_snapshot_changes(spark, sf):
    _, found = landed(spark, sf)
    out = None
    for date, changed in list(zip(DATES, found))[1:]:
        row = versions.changed_columns(changed).select(F.lit(date).alias("snapshot"), "complaint_id", "change",
                                                       F.array_join("columns", "|").alias("columns"))
        out = row if out is None else out.unionByName(row)
    return out


def _as_of_sql() -> str:
    seen = [max(k for k, d in enumerate(DATES) if d <= day) for day in LOOKED_AT]
    return f"WITH {SNAPSHOT_CTES} " + " UNION ALL ".join(
        f"SELECT DATE '{day}' AS as_of, {', '.join(SHOWN)} FROM s{k}" for day, k in zip(LOOKED_AT, seen))


@register("as_of_records", _as_of_sql, ids="SRC-09 AG-28 (records as of a day)")
def q_as_of(spark, sf):
    records, _ = landed(spark, sf)
    out = None
    for day in LOOKED_AT:
        rows = records.as_of(day).select(F.lit(day).alias("as_of"), *SHOWN)
        out = rows if out is None else out.unionByName(rows)
    return out


def trends_by_deltas(spark, sf, p, last: int = len(SNAPSHOTS) - 1) -> incremental.TrendState:
    """Trends built on the first snapshot and brought to the last by deltas."""
    state = incremental.TrendState(Store(spark, _scratch(spark, "trend-state")), p)
    before = None
    for k, date in enumerate(DATES[:last + 1]):
        rec = incremental.trend_records(Pipeline(orders_snapshot(spark, sf, k), p.with_(snapshot_date=date)).staged)
        if before is None:
            state.rebuild(rec, date)
        else:
            state.apply(versions.signed_rows(before, rec, "complaint_id"), date)
        before = rec
    return state


@register("trends_after_delta", lambda: chain(P.with_(snapshot_date=DATES[-1]), raw=snapshot_raw(SNAPSHOTS[-1])) + TREND_SQL,
          ids="AG-01 AG-02 W-01 W-02 W-03 DEC-03 (incremental)")
def q_trends_after_delta(spark, sf):
    return _trend_out(trends_by_deltas(spark, sf, P).trends())


GATED = P.with_(lag_dominance_max=0.2)


@register("gated_trends_after_delta", lambda: chain(GATED.with_(snapshot_date=DATES[-1]), raw=snapshot_raw(SNAPSHOTS[-1])) + TREND_SQL,
          ids="DEC-03 EXT-04 (incremental, lag-dominance gate)")
def q_gated_trends_after_delta(spark, sf):
    return _trend_out(trends_by_deltas(spark, sf, GATED).trends())


def late_pipelines(spark, sf) -> list[Pipeline]:
    """One for each late snapshot, over landed files: their records are read several times."""
    return [Pipeline(staged(orders_snapshot(spark, sf, k, LATE_SNAPSHOTS), "snapshot"), P.with_(snapshot_date=date)) for k, (date, _, _) in enumerate(LATE_SNAPSHOTS)]


def refreshed_marts(spark, sf) -> tuple[Store, int]:
    """Marts of the first late snapshot, brought to the second by the months it touches."""
    old, new = late_pipelines(spark, sf)
    state = incremental.TrendState(Store(spark, _scratch(spark, "trend-state")), P)
    store = Store(spark, _scratch(spark, "marts"))
    was = state.rebuild(incremental.trend_records(old.staged), old.p.snapshot_date)
    build.build_marts(Pipeline(old.raw, old.p, trends=state.trends(was)), store.root)
    signed = staged(versions.signed_rows(old.staged, new.staged, "complaint_id", build.LOAD_COLUMNS), "signed")
    now = state.apply(incremental.trend_records(signed, "weight"), new.p.snapshot_date)
    months = build.touched_months(state, was, now, signed)
    changed = state.trends(now, [m[:7] for m in months])
    return store, build.refresh_marts(Pipeline(new.raw, new.p, trends=changed), store.root, months)


def _late_sql(body: str) -> str:
    return chain(P.with_(snapshot_date=LATE_SNAPSHOTS[1][0]), raw=snapshot_raw(LATE_SNAPSHOTS[1])) + body


@register("cases_after_refresh", lambda: _late_sql(f"SELECT {', '.join(_sample_cols())} FROM cases"), ids="SNK-01 DEC-13 JN-06 (touched months only)")
def q_cases_after_refresh(spark, sf):
    store, version = refreshed_marts(spark, sf)
    return _case_out(store.read(build.CASES, version))


@register("ops_after_refresh", lambda: _late_sql(
    OPS_SQL + "UNION ALL SELECT NULL, issue_taxonomy_key, 'taxonomy', 1 FROM dim"), ids="SNK-01 SET-02 AG-05 AG-06 AG-07 (touched months only)")
def q_ops_after_refresh(spark, sf):
    """Ops metrics, and the taxonomy's keys as rows beside them."""
    store, version = refreshed_marts(spark, sf)
    keys = store.read(build.TAXONOMY, version).select(F.lit(None).cast("date").alias("metric_date"), F.col("issue_taxonomy_key").alias("dashboard_dimension"),
                                                      F.lit("taxonomy").alias("metric_name"), F.lit(1).cast("long").alias("metric_value"))
    return store.read(build.OPS, version).drop("generated_at").unionByName(keys)


class BuildFailed(RuntimeError):
    pass


def _published_sql() -> str:
    metrics = lambda k: f"(SELECT count(*) FROM (SELECT DISTINCT date_received, trim(product), trim(issue) FROM s{k} WHERE trim(issue) <> ''))"
    staged = lambda k: f"(SELECT count(*) FROM s{k} WHERE trim(issue) <> '')"
    rows = [(1, "pinned before", 0), (1, "after the failed build", 0), (1, "pinned, after the next build", 0), (2, "last", 1)]
    return f"WITH {SNAPSHOT_CTES} " + " UNION ALL ".join(
        f"SELECT {v} AS version, '{name}' AS reader, {metrics(k)} AS metric_rows, {staged(k)} AS records" for v, name, k in rows)


@register("published_version", _published_sql, ids="SNK-01 SRC-10 (atomic publication, pinned readers)")
def q_published_version(spark, sf):
    """Publish two tables, fail while building the next pair, publish it: who reads what."""
    store = Store(spark, _scratch(spark, "published"))

    def build(k: int, fail: bool = False) -> int:
        pl = Pipeline(orders_snapshot(spark, sf, k), P.with_(snapshot_date=DATES[k]))
        base = store.current()
        tables = {"metrics": store.write(pl.fdm)}
        if fail:
            raise BuildFailed("after the first table")
        return store.publish(tables | {"records": store.write(pl.staged.select("complaint_id"))}, base)

    def seen(reader: str, version: int):
        n = lambda name: store.read(name, version).agg(F.count(F.lit(1))).scalar()
        return spark.range(1).select(F.lit(version).alias("version"), F.lit(reader).alias("reader"), n("metrics").alias("metric_rows"), n("records").alias("records"))

    first = build(0)
    out = seen("pinned before", first)
    try:
        build(1, fail=True)
    except BuildFailed:
        out = out.unionByName(seen("after the failed build", store.current()))
    build(1)
    return out.unionByName(seen("pinned, after the next build", first)).unionByName(seen("last", store.current()))


@register("concurrent_run_refused", lambda: orders_sql(
    "SELECT 'run-1' AS load_run_id, count(*) AS n, 1 AS refused, 1 AS stale_commits_refused FROM raw_cases"), ids="SRC-09 (two loads at once)")
def q_concurrent_run(spark, sf):
    """Two loads of one run id at the same time: the table has its rows once.  A
    writer that still builds on the version before them is refused as well."""
    landed_at, table = land_orders(spark, sf), _scratch(spark, "runs")
    store = Store(spark, table)
    base = store.current()

    def load(_):
        try:
            rw.load_run(spark, landed_at, table, "run-1", URL, RETRIEVED, P.snapshot_date)
            return 0
        except rw.LoadRefused:
            return 1

    with ThreadPoolExecutor(2) as pool:
        refused = sum(pool.map(load, range(2)))
    try:
        store.commit(base, {})
        stale = 0
    except Conflict:
        stale = 1
    return (rw.read_runs(spark, table).groupBy("load_run_id").agg(F.count(F.lit(1)).alias("n"))
            .select("load_run_id", "n", F.lit(refused).alias("refused"), F.lit(stale).alias("stale_commits_refused")))
