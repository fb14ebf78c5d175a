"""Versioned tables, snapshot differences and trends by deltas on awkward frames."""

import datetime as dt
import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import incremental, trends, versions
from ledgerline.params import Params
from ledgerline.plans import build
from ledgerline.plans.pipeline import Pipeline
from ledgerline.sources.sinks import staged
from ledgerline.sources.store import AlreadyThere, Conflict, Store, Table
from helpers import raw_frame

D = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2024, 4, 1)]


def bag(df):
    return Counter(map(tuple, df.collect()))


# -- store -----------------------------------------------------------------------

def test_publish_is_all_or_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s t+o=re"))           # a path with characters that are escaped
    assert store.current() == 0 and store.manifest(0) == {}
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert store.publish({"t": store.write(one), "u": store.write(one)}) == 1
    pinned = store.read("t", 1)
    store.write(one.filter("id = 1"))                             # a build that never commits
    assert store.current() == 1 and bag(store.read("t")) == bag(one)
    base = store.current()
    assert store.publish({"t": store.write(one.filter("id = 1"))}, base) == 2
    with pytest.raises(Conflict):
        store.publish({"t": store.write(one)}, base)              # built on a version that is not the last
    assert bag(pinned) == bag(one) and bag(store.read("t")) == Counter({(1, "a"): 1})
    assert bag(store.read("u")) == bag(one)                       # carried over by reference
    assert store.manifest(2)["u"] == store.manifest(1)["u"]


def test_one_of_many_writers_wins(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    spark.range(1).write.parquet(f"{tmp_path}/data/x")

    def commit(_):
        try:
            return store.commit(0, {"t": Table(spark.range(1).schema.json(), {"": ["data/x"]})})
        except Conflict:
            return 0

    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(commit, range(16))) == [0] * 15 + [1]
    assert store.read("t").count() == 1


def test_appends_at_once_all_land_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    part = {k: store.write(spark.range(k + 1).withColumn("run", F.lit(k)), f"run-{k}") for k in range(4)}

    def append(k):
        try:
            store.append("raw", part[k % 4])
            return 1
        except AlreadyThere:
            return 0

    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(append, range(8))) == 4
    assert bag(store.read("raw").groupBy("run").count()) == Counter({(k, k + 1): 1 for k in range(4)})
    assert bag(store.read("raw", keys=["run-2"]).select("run")) == Counter({(2,): 3})
    with pytest.raises(ValueError):
        store.append("raw", store.write(spark.range(1), "other-schema"))


def test_parts_by_key_and_vacuum(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.createDataFrame([(i, f"2024-0{1 + i % 3}" if i else None) for i in range(10)], "id int, month string")
    store.publish({"t": store.write(rows, by="month")})
    assert set(store.keys("t")) == {"2024-01", "2024-02", "2024-03", "none"}
    one = store.read("t", keys=["2024-02", "2024-09"])
    assert bag(one) == bag(rows.filter("month = '2024-02'")) and all("2024-02" in f for f in one.inputFiles())
    for k in range(3):
        store.publish({"t": store.write(rows.limit(k + 1))})
    store.write(rows)
    assert store.vacuum(keep=2, idle_hours=1) == 0               # young files stay, versions go
    assert store.versions() == [3, 4]
    assert store.vacuum(keep=2, idle_hours=-1) == 3              # what version 1 and 2 named, and the stray files
    assert store.read("t", 3).count() == 2 and store.read("t").count() == 3


def test_empty_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish({"t": store.write(spark.range(0).withColumn("m", F.lit("a")), by="m")})
    assert store.read("t").columns == ["id", "m"] and store.read("t").count() == 0


# -- versions --------------------------------------------------------------------

ROW = "complaint_id string, product string, note string"


def snapshots(seed: int) -> list[list[tuple]]:
    r = random.Random(seed)
    ids = ["1", "2", "3", "4", "5", "6", None, ""]
    out = []
    for _ in range(4):
        out.append([(r.choice(ids), r.choice(["a", "b", None, ""]), r.choice(["x", None])) for _ in range(r.choice([0, 12, 25]))])
    return [out[1] or [("1", "a", None)], *out[1:]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_versions_give_back_every_snapshot(spark, tmp_path, seed):
    """Ids missing, empty and repeated; rows repeated; snapshots empty: as_of has the very multiset."""
    landed = snapshots(seed)
    records = versions.VersionedRecords(Store(spark, str(tmp_path)))
    for date, rows in zip(D, landed):
        new = spark.createDataFrame(rows, ROW)
        found = records.apply_snapshot(new, date).collect()
        before = Counter(landed[D.index(date) - 1]) if date != D[0] else Counter()
        gone, come = before - Counter(rows), Counter(rows) - before
        assert Counter(tuple(x["old"]) for x in found if x["old"]) == gone
        assert Counter(tuple(x["new"]) for x in found if x["new"]) == come
        for x in found:
            assert (x["change"] == "changed") == bool(x["old"] and x["new"])
            assert all(s["complaint_id"] == x["complaint_id"] for s in (x["old"], x["new"]) if s)
        # as few come and go without a partner as can be
        for i in {r[0] for r in [*gone, *come]} - {None}:
            a, b = (sum(n for r, n in c.items() if r[0] == i) for c in (gone, come))
            assert sum(x["change"] == "changed" for x in found if x["complaint_id"] == i) == min(a, b)
    for date, rows in zip(D, landed):
        assert bag(records.as_of(date)) == Counter(rows)
        assert bag(records.as_of(date + dt.timedelta(days=9))) == Counter(rows)
    assert records.as_of(dt.date(2023, 12, 31)).count() == 0
    with pytest.raises(ValueError):
        records.apply_snapshot(spark.createDataFrame(landed[0], ROW), D[2])


def test_unchanged_snapshot_keeps_the_open_part(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    records = versions.VersionedRecords(store, ignore=("loaded",))
    rows = spark.createDataFrame([("1", "a", 1), ("2", None, 1)], "complaint_id string, product string, loaded int")
    records.apply_snapshot(rows, D[0])
    before = store.manifest(1)["records"].parts["open"]
    assert records.apply_snapshot(rows.withColumn("loaded", F.lit(2)), D[1]).count() == 0
    assert store.manifest(2)["records"].parts["open"] == before
    late = records.as_of(D[3])
    assert late.count() == 2 and not any(k in f for f in late.inputFiles() for k in store.manifest(2)["records"].parts[D[1].isoformat()])


def test_changed_columns_and_clashing_names(spark):
    schema = "complaint_id string, row_hash string, weight string, n_old string, d_key string, copy string"
    old = spark.createDataFrame([("1", "a", "b", None, "k", "c"), ("2", "a", "b", None, "k", "c")], schema)
    new = spark.createDataFrame([("1", "a", "z", "", "k", "c"), ("3", "a", "b", None, "k", "c")], schema)
    with pytest.raises(ValueError):
        versions.changes(old, new)
    plain = ["complaint_id", "x", "y", "z"]
    a, b = (df.select("complaint_id", *[F.col(c).alias(n) for c, n in zip(("d_key", "weight", "n_old"), plain[1:])]) for df in (old, new))
    got = {(r["complaint_id"], r["change"], tuple(r["columns"] or ())) for r in versions.changed_columns(versions.changes(a, b)).collect()}
    assert got == {("1", "changed", ("y", "z")), ("2", "withdrawn", ()), ("3", "added", ())}


# -- trends by deltas --------------------------------------------------------------

def trend_rows(r, n, ids):
    return [(str(r.choice(ids)), dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(150)) if r.random() < .97 else None,
             r.choice(["p", "q"]), r.choice(["i", "j", None]), r.random() < .3) for _ in range(n)]


@pytest.mark.parametrize("gate", [None, 0.4])
@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_equal_a_rebuild(spark, tmp_path, seed, gate):
    p = Params(cur=3, base=9, min_cur=2, min_base=2, lag_days=20, lag_dominance_max=gate)
    r = random.Random(seed)
    schema = "complaint_id string, complaint_received_date date, product string, issue string, in_progress boolean"
    state = incremental.TrendState(Store(spark, str(tmp_path)), p)
    rows, before = trend_rows(r, 80, range(200)), None
    for date in (dt.date(2024, 5, 1), dt.date(2024, 5, 20), dt.date(2024, 6, 3)):
        rec = spark.createDataFrame(rows, schema)
        if before is None:
            state.rebuild(rec, date)
        else:
            state.apply(versions.signed_rows(before, rec, "complaint_id"), date)
        flag = F.date_diff(F.lit(date), F.col("complaint_received_date")) <= p.lag_days
        vol = trends.daily_volume(rec.withColumn("recent_publication_lag_flag", flag | F.col("in_progress")))
        assert bag(state.trends()) == bag(trends.issue_trends(vol, p))
        before = rec
        rows = [x for x in rows if r.random() < .95] + trend_rows(r, 6, range(200, 300))


def test_only_touched_months_are_written(spark, tmp_path):
    p = Params(cur=2, base=5, min_cur=1, min_base=1)
    schema = "complaint_id string, complaint_received_date date, product string, issue string, in_progress boolean"
    rows = [(str(k), dt.date(2024, 1, 3) + dt.timedelta(days=7 * k), "p", "i", False) for k in range(40)]
    old, new = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + [("x", dt.date(2024, 4, 12), "p", "i", False)], schema)
    store = Store(spark, str(tmp_path))
    state = incremental.TrendState(store, p)
    state.rebuild(old, D[3])
    state.apply(versions.signed_rows(old, new, "complaint_id"), D[3])
    for name, touched in (("trend_volume", {"2024-04"}), ("trend_sums", {"2024-04"})):
        a, b = store.manifest(1)[name].parts, store.manifest(2)[name].parts
        assert {k for k in a | b if a.get(k) != b.get(k)} == touched
    assert state.trends(1).count() == 40 and state.trends().count() == 41
    nothing = versions.signed_rows(new, new, "complaint_id")
    assert nothing.count() == 0
    state.apply(nothing, D[3])
    assert store.manifest(3)["trend_sums"] == store.manifest(2)["trend_sums"]


# -- marts by touched months -------------------------------------------------------

def landed_records(seed: int) -> list[dict]:
    r = random.Random(seed)
    return [{"complaint_id": str(k), "date_received": str(dt.date(2023, 1, 1) + dt.timedelta(days=r.randrange(360))), "product": r.choice(["p", "q"]),
             "issue": r.choice(["i", "j", ""]), "timely_response": r.choice(["Yes", "No", ""]), "sub_issue": r.choice(["s", ""]),
             "company_response_to_consumer": r.choice(["In progress", "Closed"])} for k in range(300)]


def marts_of(store, version):
    """Every mart as a bag, without the times at which rows were made."""
    out = {}
    for name in (build.DECIDED, build.FACT, build.QUEUE, build.CASES, build.METRICS, build.OPS, build.TAXONOMY):
        rows = store.read(name, version).drop("generated_at", "source_snapshot_date", "evidence_fields")
        out[name] = Counter(map(str, (tuple(x) for x in rows.select(sorted(rows.columns)).collect())))
    return out


def test_refreshed_marts_equal_a_build(spark, tmp_path):
    dates = [dt.date(2023, 12, 10), dt.date(2023, 12, 30)]
    p = [Params(cur=3, base=9, min_cur=2, min_base=2, lag_days=20, snapshot_date=d) for d in dates]
    before = landed_records(4)
    after = [x for x in before if x["complaint_id"] not in ("7", "8")] + [dict(before[0], complaint_id="new", date_received="2023-06-28")]
    after = [dict(x, timely_response="No", company="Other") if x["complaint_id"] == "11" else x for x in after]
    old, new = (Pipeline(raw_frame(spark, rows, d), q) for rows, d, q in zip((before, after), dates, p))
    state = incremental.TrendState(Store(spark, str(tmp_path / "trends")), p[0])
    root = str(tmp_path / "marts")
    store = Store(spark, root)
    was = state.rebuild(incremental.trend_records(old.staged), dates[0])
    assert build.build_marts(Pipeline(old.raw, old.p, trends=state.trends()), root) == 1
    signed = staged(versions.signed_rows(old.staged, new.staged, "complaint_id", build.LOAD_COLUMNS), "signed")
    now = state.apply(incremental.trend_records(signed, "weight"), dates[1])
    months = build.touched_months(state, was, now, signed)
    assert set(months) < set(store.keys(build.DECIDED)) and {"2023-06-01", "2023-07-01", "2023-11-01", "2023-12-01"} <= set(months)
    assert build.refresh_marts(Pipeline(new.raw, new.p, trends=state.trends(now, [m[:7] for m in months])), root, months) == 2
    fresh = str(tmp_path / "fresh")
    build.build_marts(new, fresh)
    assert marts_of(store, 2) == marts_of(Store(spark, fresh), 1)
    for name in (build.DECIDED, build.FACT, build.QUEUE, build.CASES, build.METRICS):
        a, b = (store.manifest(v)[name].parts for v in (1, 2))
        assert {k for k in a | b if a.get(k) != b.get(k)} <= set(months) and any(a[k] == b.get(k) for k in a)
    # no month touched: nothing but the small tables is written
    assert build.refresh_marts(new, root, []) == 3
    assert all(store.manifest(3)[n] == store.manifest(2)[n] for n in (build.DECIDED, build.QUEUE, build.METRICS))


def test_refresh_refuses_other_columns(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    pl = Pipeline(raw_frame(spark, [{}]), Params(cur=3, base=9, snapshot_date=dt.date(2024, 12, 31)))
    build.build_marts(pl, str(tmp_path))
    store.publish({build.QUEUE: store.write(spark.range(1).withColumn(build.MONTH, F.lit("2024-03-01")), by=build.MONTH)})
    with pytest.raises(ValueError):
        build.refresh_marts(pl, str(tmp_path), ["2024-03-01"])
    assert store.current() == 2


def test_changes_read_only_what_went_and_came(spark, tmp_path):
    """Records are looked up once a snapshot: the first is written as it is, and changes
    come from the rows found, not from all records again."""
    store = Store(spark, str(tmp_path / "store"))
    records = versions.VersionedRecords(store)
    rows = [spark.createDataFrame([(str(i), "a" if i % 10 else v, None) for i in range(200)], ROW) for v in "bc"]
    for k, df in enumerate(rows):
        df.write.parquet(str(tmp_path / f"landed{k}"))
    landed = [spark.read.parquet(str(tmp_path / f"landed{k}")) for k in range(2)]
    records.apply_snapshot(landed[0], D[0])
    assert len(store._names("data")) == 2                       # the records, and no closed ones
    found = records.apply_snapshot(landed[1], D[1])
    assert all("/store/data/" in f for f in found.inputFiles())
    assert found.count() == 20 and {r["change"] for r in found.collect()} == {"changed"}
    kept = set(store.manifest(2)["records"].parts["open"]) | set(store.manifest(2)["records"].parts[D[1].isoformat()])
    untouched = [p for p in kept if p.endswith("=still")]
    assert untouched and not any(p in f for p in untouched for f in found.inputFiles())


def test_decided_files_are_small(spark, tmp_path, monkeypatch):
    """What a task of the month tables sorts is bounded by the rows of a decided file."""
    monkeypatch.setattr(build, "FILE_ROWS", 3)
    store = Store(spark, str(tmp_path))
    build.build_marts(Pipeline(raw_frame(spark, landed_records(4), dt.date(2023, 12, 10)), Params(cur=3, base=9, snapshot_date=dt.date(2023, 12, 10))), str(tmp_path))
    rows = store.read(build.DECIDED).groupBy("_metadata.file_path").count()
    assert rows.agg(F.max("count")).first()[0] == 3 and store.read(build.CASES).count() == store.read(build.DECIDED).count()


def test_late_snapshots_are_landed_once(spark):
    from conftest import SF_SMALL
    from ledgerline.plans.q_versions import late_pipelines
    for pl in late_pipelines(spark, SF_SMALL):
        assert not any("orders" in f for f in pl.wide.inputFiles()) and pl.raw.count()


def test_documents_read_records_made_once(spark):
    from conftest import SF_SMALL
    from ledgerline.plans import q_defaults
    from ledgerline.plans.pipeline import ArchivePipeline
    for sections in q_defaults.documents(q_defaults.made_once(ArchivePipeline.orders(spark, SF_SMALL))).values():
        for df in sections.values():
            assert not any(f"{t}.parquet/" in f + "/" for f in df.inputFiles() for t in ("orders", "customer"))
