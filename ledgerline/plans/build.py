"""Materialise the marts (SNK-01): the production path.

1. daily volume and trends are written by the pipeline (aggregate tables);
2. the decided record rows are computed in ONE record-level pass (scan, adaptive
   trend join, narrow decision columns) and written once, a part for each
   received month: the only shuffle of record-wide rows;
3. fact, queue and case context are narrow projections of those files, written month
   by month as they are read;
4. daily metrics and the counts of records by taxonomy and action are small tables
   by month; ops metrics and the taxonomy follow from these;
5. one commit publishes all of them: readers see the old marts or the new ones,
   and a build that fails changes nothing.

After a snapshot that corrects some records, `touched_months` names the months that
can differ: those of the records that went and came, those whose trends changed, and
those of days that left the publication-lag window.  `refresh_marts` decides only
these anew; the files of all other months are named again, neither read nor written.
Their queue rows keep the snapshot date and the time at which they were decided.

Every output lives under `root` (a shared folder), see `sources.store`.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import conform, marts, policy
from ledgerline.operators.incremental import TrendState
from ledgerline.params import Params
from ledgerline.plans.pipeline import Pipeline
from ledgerline.sources.store import Store, Table

MONTH = "received_month"
DECIDED, FACT, QUEUE, CASES, METRICS, OPS, TAXONOMY = (
    "decided", "fct_complaints", "resolution_action_queue", "agent_case_context", "fct_issue_daily_metrics",
    "operations_overview_metrics", "dim_issue_taxonomy")
COUNTS = "month_counts"
#: Rows to a file of decided records.  The tables made of them are written as they are
#: read, sorted by month within each task: Spark packs so many small files into a task,
#: whatever the size of the table, that this takes less than 1 GB.
FILE_ROWS = 20_000
#: Columns of a staged record that say of which load or day it is, not what it says.
LOAD_COLUMNS = (*(name for name, _ in conform.LINEAGE), "recent_publication_lag_flag")


def _with_month(df: DataFrame, day: str = "complaint_received_date") -> DataFrame:
    return df.withColumn(MONTH, F.trunc(day, "MM"))


def _by_month(store: Store, wide: DataFrame, metrics: DataFrame, p: Params) -> dict[str, Table]:
    """The tables that have a part for each month, from decided records and daily metrics."""
    decided = store.write(_with_month(wide), by=MONTH, writer=lambda w: w.option("maxRecordsPerFile", FILE_ROWS))
    d = store.frame(decided)
    counts = d.groupBy(MONTH, *marts.TAXONOMY_COLS, "recommended_action", "source_snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    return {
        DECIDED: decided,
        FACT: store.write(_with_month(marts.fact(d)), by=MONTH, gather=False),
        QUEUE: store.write(policy.action_queue(d, p, MONTH), by=MONTH, gather=False),
        CASES: store.write(_with_month(marts.agent_context(d, p)), by=MONTH, gather=False),
        COUNTS: store.write(counts, by=MONTH),
        METRICS: store.write(_with_month(metrics, "metric_date"), by=MONTH),
    }


def _small(store: Store, tables: dict[str, Table], p: Params) -> dict[str, Table]:
    """Ops metrics and taxonomy, from small tables of all months."""
    metrics, counts = store.frame(tables[METRICS]), store.frame(tables[COUNTS])
    ops = marts.volume_metric(metrics).unionByName(marts.emerging_counts(metrics)).unionByName(marts.action_totals(counts, p))
    return {OPS: store.write(ops), TAXONOMY: store.write(marts.taxonomy(counts))}


def build_marts(pl: Pipeline, root: str) -> int:
    """Build all marts and publish them; returns their version."""
    store = Store(pl.spark, root)
    base = store.current()
    tables = _by_month(store, pl.wide, pl.fdm, pl.p)
    return store.publish(tables | _small(store, tables, pl.p), base)


def touched_months(state: TrendState, was: int, now: int, signed: DataFrame) -> list[str]:
    """Keys of the month parts that can differ between two versions of the trends.
    `signed`: the records that went and came in between (`versions.signed_rows`)."""
    months = state.changed_months(was, now)
    first, last = sorted(state.snapshot(v) - dt.timedelta(days=state.p.lag_days) for v in (was, now))
    months |= {f"{first + dt.timedelta(days=k):%Y-%m}" for k in range((last - first).days + 1)}
    moved = signed.select(F.date_format("complaint_received_date", "yyyy-MM").alias("m")).filter("m is not null").distinct()
    months |= {r["m"] for r in moved.collect()}          # as many as the calendar has
    return sorted(f"{m}-01" for m in months)


def refresh_marts(pl: Pipeline, root: str, months: Iterable[str]) -> int:
    """Build the parts of these months anew, from a pipeline over the new snapshot, and
    publish them beside the other months' files; returns the version."""
    store, wanted = Store(pl.spark, root), sorted(set(months))
    base = store.current()
    was = store.manifest(base)
    inside = lambda day: F.trunc(day, "MM").cast("string").isin(wanted)
    new = _by_month(store, pl.wide.filter(inside("complaint_received_date")), pl.fdm.filter(inside("metric_date")), pl.p)
    tables = {}
    for name, table in new.items():
        if store.frame(table).columns != store.frame(was[name], []).columns:
            raise ValueError(f"{name} has other columns now: build all months")
        tables[name] = was[name].with_parts(table.parts, wanted)
    return store.publish(tables | _small(store, tables, pl.p), base)


def months_between(first: dt.date, last: dt.date) -> list[str]:
    """Keys of the month parts that hold the days from first to last."""
    n = (last.year - first.year) * 12 + last.month - first.month
    return [dt.date(first.year + (first.month - 1 + k) // 12, (first.month - 1 + k) % 12 + 1, 1).isoformat() for k in range(n + 1)]


def read_window(store: Store, name: str, first: dt.date, last: dt.date, version: int | None = None) -> DataFrame:
    """SRC-10: rows of a mart received from first to last; the manifest names the
    months to read, so no other file is listed."""
    d = F.col("complaint_received_date")
    return store.read(name, version, months_between(first, last)).filter((d >= F.lit(first)) & (d <= F.lit(last)))
