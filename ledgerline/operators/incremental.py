"""Trends kept up to date by deltas (AG-01, AG-02, W-01..W-03, DEC-03).

A snapshot changes few records, but every trend row looks back over a range
frame.  The state is additive, so it is maintained, not rebuilt:

1. the records that went and came are summed to signed daily deltas;
2. the months with a delta get new daily volumes;
3. each delta is spread to the days whose frame holds it (current window,
   baseline, all-issue total), and those sums are added to the rows there;
4. a cell that had no record before gets its frames from the volumes around it,
   one that has none any more goes.

Only months that hold a touched day are read and written; the others are named
again in the store's next version, and volumes, state and snapshot date change
in one commit.  What a flag of the publication lag says of a day depends on the
snapshot date, so the days that leave the lag window count as touched where the
parameters use it.  The lists of touched months reach the driver: as many as
the calendar has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.operators import trends as tr
from ledgerline.params import Params
from ledgerline.sources.store import Store, Table

CELL = ["product", "issue"]
IN_PROGRESS = "In progress"
RECORD = ["complaint_id", "complaint_received_date", "product", "issue", "in_progress"]


def trend_records(rec: DataFrame, *keep: str) -> DataFrame:
    """What of a record its trends depend on, and columns `keep`; comparing these finds
    the changes."""
    return rec.select("complaint_id", "complaint_received_date", "product", "issue", F.col("company_response").eqNullSafe(IN_PROGRESS).alias("in_progress"), *keep)


def _month(day: Column | str = "metric_date") -> Column:
    return F.date_format(F.col(day) if isinstance(day, str) else day, "yyyy-MM")


def _months(days: DataFrame) -> list[str]:
    return sorted(r[0] for r in days.select(_month().alias("m")).distinct().collect())


def _months_back(months: list[str], days: int) -> set[str]:
    """These months and those that hold any of the `days` days before them."""
    out = set(months)
    for m in months:
        first = dt.date(int(m[:4]), int(m[5:]), 1)
        at = first - dt.timedelta(days=days)
        while at < first:
            out.add(f"{at:%Y-%m}")
            at = (at.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return out


class TrendState:
    """Daily volumes (`<name>_volume`) and window sums (`<name>_sums`) by month in
    a store, and the snapshot they stand for (`<name>_snapshot`)."""

    def __init__(self, store: Store, p: Params, name: str = "trend"):
        self.store, self.p, self.volume, self.sums, self.stamp = store, p, f"{name}_volume", f"{name}_sums", f"{name}_snapshot"

    # -- pieces ------------------------------------------------------------------
    def _lagged(self, snapshot: dt.date, count: str = "complaint_count", progress: str = "progress_count") -> Column:
        """Lag-flagged records of a day: all of them inside the lag window, those in
        progress before it."""
        inside = F.date_diff(F.lit(snapshot), F.col("metric_date")) <= self.p.lag_days
        return F.when(inside, F.col(count)).otherwise(F.col(progress))

    def _windows(self, vol: DataFrame, snapshot: dt.date) -> DataFrame:
        """All window sums of these volumes, by range windows."""
        v = vol.withColumn("lag_flagged_count", self._lagged(snapshot))
        win = tr.issue_windows(v, self.p.with_(lag_dominance_max=self.p.lag_dominance_max or 0.0))
        return win.join(tr.total_rolling(v, self.p), "metric_date", "left")

    def _stamped(self, snapshot: dt.date) -> Table:
        return self.store.write(self.store.spark.createDataFrame([(snapshot,)], "snapshot date").coalesce(1), snapshot.isoformat())

    # -- build, apply, read ------------------------------------------------------
    def rebuild(self, records: DataFrame, snapshot: dt.date) -> int:
        """From all records (`trend_records`)."""
        base = self.store.current()
        vol = (records.filter("complaint_received_date is not null and product is not null and issue is not null")
               .groupBy(F.col("complaint_received_date").alias("metric_date"), *CELL)
               .agg(F.count(F.lit(1)).alias("complaint_count"), F.count_if("in_progress").alias("progress_count")))
        volume = self._by_month(vol)
        sums = self._by_month(self._windows(self.store.frame(volume), snapshot))
        return self.store.commit(base, self.store.manifest(base) | {self.volume: volume, self.sums: sums, self.stamp: self._stamped(snapshot)})

    def _by_month(self, df: DataFrame) -> Table:
        table = self.store.write(df.withColumn("month", _month()), by="month")
        return Table(df.withColumn("month", _month()).schema.json(), table.parts)

    def apply(self, signed: DataFrame, snapshot: dt.date) -> int:
        """From the records that went and came since (`versions.signed_rows` of
        `trend_records`)."""
        base, p, store = self.store.current(), self.p, self.store
        tables = store.manifest(base)
        volume, sums = tables[self.volume], tables[self.sums]
        before = self.snapshot(base)

        # 1: signed daily deltas
        deltas = (signed.filter("complaint_received_date is not null and product is not null and issue is not null")
                  .groupBy(F.col("complaint_received_date").alias("metric_date"), *CELL)
                  .agg(F.sum("weight").alias("d_count"), F.sum(F.when(F.col("in_progress"), F.col("weight")).otherwise(0)).alias("d_progress"))
                  .filter("d_count <> 0 or d_progress <> 0"))
        deltas = store.frame(store.write(deltas))

        # 2: volumes of the touched months
        touched = set(_months(deltas))
        if p.lag_dominance_max is not None:              # days that leave (or enter) the lag window
            first, last = sorted(s - dt.timedelta(days=p.lag_days) for s in (before, snapshot))
            touched |= {f"{first + dt.timedelta(days=k):%Y-%m}" for k in range((last - first).days + 1)}
        keys = ["metric_date", *CELL]
        was = store.frame(volume, touched).select(*keys, "complaint_count", "progress_count")
        merged = was.join(deltas, keys, "full_outer").select(
            *keys, F.coalesce("complaint_count", F.lit(0)).alias("was_count"), F.coalesce("progress_count", F.lit(0)).alias("was_progress"),
            *[(F.coalesce(a, F.lit(0)) + F.coalesce(d, F.lit(0))).alias(a) for a, d in (("complaint_count", "d_count"), ("progress_count", "d_progress"))])
        cells = merged.withColumns({"now_lag": self._lagged(snapshot), "was_lag": self._lagged(before, "was_count", "was_progress")})
        cells = store.frame(store.write(cells))
        now = self._by_month(cells.filter("complaint_count > 0").select(*keys, "complaint_count", "progress_count"))
        new_volume = Table(volume.schema, volume.with_parts(now.parts, touched).parts)

        # 3: spread to the frames that hold them
        moved = cells.withColumns({"d_count": F.col("complaint_count") - F.col("was_count"), "d_lag": F.col("now_lag") - F.col("was_lag")})
        moved = store.frame(store.write(moved.filter("d_count <> 0 or d_lag <> 0").select(*keys, "d_count", "d_lag")))
        spread = (tr.frame_sum(moved, "d_count", p.cur_frame, "d_current", CELL)
                  .join(tr.frame_sum(moved, "d_count", p.base_frame, "d_baseline", CELL), keys, "full_outer")
                  .join(tr.frame_sum(moved, "d_lag", p.cur_frame, "d_lagged", CELL), keys, "full_outer")
                  .filter("d_current <> 0 or d_baseline <> 0 or d_lagged <> 0"))
        spread = store.frame(store.write(spread))
        total = tr.frame_sum(moved.groupBy("metric_date").agg(F.sum("d_count").alias("d")), "d", p.cur_frame, "d_total").filter("d_total <> 0")
        total = store.frame(store.write(total))
        new_cells = cells.filter("was_count = 0 and complaint_count > 0").select(*keys)
        months = set(_months(spread)) | set(_months(total)) | set(_months(new_cells))
        months &= set(sums.parts) | touched

        # 4: rows of the touched months
        old = store.frame(sums, months).drop("month")
        plus = lambda a, d: F.coalesce(a, F.lit(0)) + F.coalesce(d, F.lit(0))
        kept = (old.join(cells.select(*keys, F.col("complaint_count").alias("now_count")), keys, "left")
                .withColumn("complaint_count", F.coalesce("now_count", "complaint_count")).filter("complaint_count > 0")
                .join(spread, keys, "left").join(total, "metric_date", "left")
                .select(*keys, "complaint_count", plus("issue_volume_current", "d_current").alias("issue_volume_current"),
                        F.nullif(plus("baseline_volume_raw", "d_baseline"), F.lit(0)).alias("baseline_volume_raw"),
                        plus("lag_volume_current", "d_lagged").alias("lag_volume_current"),
                        plus("total_volume_current", "d_total").alias("total_volume_current")))
        reach = _months_back(sorted(months), -p.base_frame[0])
        around = store.frame(new_volume, reach).drop("month").withColumn("lag_flagged_count", self._lagged(snapshot))
        made = self._at(new_cells, around)
        done = self._by_month(kept.unionByName(made))
        new_sums = Table(sums.schema, sums.with_parts(done.parts, months).parts)
        return store.commit(base, tables | {self.volume: new_volume, self.sums: new_sums, self.stamp: self._stamped(snapshot)})

    def _at(self, cells: DataFrame, vol: DataFrame) -> DataFrame:
        """Window sums of single cells from the volumes around them: one row for each
        cell and day of its frames, summed."""
        p, at = self.p, cells.select(F.col("metric_date").alias("at"), *CELL)
        age = F.date_diff(F.col("metric_date"), F.col("at"))
        within = lambda frame: (age >= frame[0]) & (age <= frame[1])
        near = at.join(vol, CELL).filter((age >= p.base_frame[0]) & (age <= p.cur_frame[1]))
        add = lambda value, frame: F.sum(F.when(within(frame), F.col(value)))
        own = F.sum(F.when(age == 0, F.col("complaint_count")))
        rows = near.groupBy(F.col("at"), *CELL).agg(
            own.alias("complaint_count"), add("complaint_count", p.cur_frame).alias("issue_volume_current"),
            add("complaint_count", p.base_frame).alias("baseline_volume_raw"), add("lag_flagged_count", p.cur_frame).alias("lag_volume_current"))
        return rows.withColumnRenamed("at", "metric_date").join(tr.total_rolling(vol, p), "metric_date", "left")

    def changed_months(self, was: int, now: int) -> set[str]:
        """Months (yyyy-MM) whose trends differ between two versions."""
        a, b = (self.store.manifest(v)[self.sums].parts for v in (was, now))
        return {k for k in a | b if a.get(k) != b.get(k)}

    def snapshot(self, version: int) -> dt.date:
        return dt.date.fromisoformat(next(iter(self.store.manifest(version)[self.stamp].parts)))

    def trends(self, version: int | None = None, months: Iterable[str] | None = None) -> DataFrame:
        """`trends.issue_trends` of the snapshot, or of some of its months, from the state."""
        rows = self.store.read(self.sums, version, months)
        out = tr.with_pattern_status(tr.with_change_and_share(tr.with_baseline(rows, self.p)), self.p)
        return out.select(*[F.col({"daily_complaint_count": "complaint_count"}.get(c, c)).alias(c) if c != "policy_id" else F.lit(fixed.TREND_POLICY_ID).alias(c)
                            for c in tr.TREND_COLUMNS])
