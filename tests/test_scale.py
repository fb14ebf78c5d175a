"""Bitmaps, summaries, profiles and the lattice against plain counts."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import archive, bitmaps, heavy, profiles
from ledgerline.sources.store import AlreadyThere, Store


def test_bitmaps_of_awkward_ids(spark):
    r = random.Random(3)
    ids = [None, "", " ", "0", "00", "007", "-5", "1.0", "x", "9" * 18, "9" * 19, "32767", "32768", "32769"] + [str(r.randrange(3000)) for _ in range(4000)]
    rows = spark.createDataFrame([(x, k % 2) for k, x in enumerate(ids)], "id string, part int").repartition(5)
    want = Counter(x for x in ids if x is not None)
    assert bitmaps.id_counts(rows, "id").first()[:] == (sum(want.values()), len(want), sum(want.values()) - len(want))
    assert Counter({r["key_value"]: r["n"] for r in bitmaps.repeated_ids(rows, "id").collect()}) == Counter({k: n for k, n in want.items() if n > 1})
    by = {r["part"]: (r["ids"], r["distinct_ids"]) for r in bitmaps.id_counts(rows, "id", ["part"]).collect()}
    for p in (0, 1):
        mine = [x for k, x in enumerate(ids) if k % 2 == p and x is not None]
        assert by[p] == (len(mine), len(set(mine)))
    assert bitmaps.id_counts(rows.limit(0), "id").first()[:] == (0, 0, 0)
    assert bitmaps.repeated_ids(rows.limit(0), "id").collect() == []


def test_dense_ids_shuffle_bitmaps_only(spark):
    rows = spark.range(100_000, numPartitions=4).select(F.col("id").cast("string").alias("id"))
    dense, other = bitmaps._split(bitmaps._keyed(rows, [], "id"), [])
    assert dense.count() == 100_000 and other.count() == 0
    assert bitmaps._blocks(dense, []).count() == 5                     # 4 blocks of 32,768 and 0 before them
    assert bitmaps.id_counts(rows, "id").first()["distinct_ids"] == 100_000
    halves = [bitmaps.run_bitmaps(rows.filter(f"cast(id as long) {op}"), "id") for op in ("< 60000", ">= 40000")]
    assert bitmaps.merged_distinct(halves[0].unionByName(halves[1])).first()[0] == 100_000


def test_a_stray_id_leaves_the_others_dense(spark):
    ids = spark.range(70_000, numPartitions=4).select(F.col("id").cast("string").alias("id"))
    rows = ids.unionByName(spark.createDataFrame([("9" * 17,), ("9" * 17,), ("123456789012",)], "id string"))
    for by, df in (([], rows), (["kind"], rows.withColumn("kind", F.lit("a")))):
        dense, other = bitmaps._split(bitmaps._keyed(df, by, "id"), by)
        assert dense.count() == 70_000 and other.count() == 3
        assert bitmaps.id_counts(df, "id", by).first()[-3:] == (70_003, 70_002, 1)
        assert [r[-2:] for r in bitmaps.repeated_ids(df, "id", by).collect()] == [("9" * 17, 2)]


def test_rows_are_not_shuffled_to_meet_short_lists(spark):
    """Whatever the size of the rows: the lists they are joined to are written, and so known to be short."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        rows = spark.range(200_000, numPartitions=4).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("kind"),
                                                            F.when(F.col("id") % 3 > 0, "often").otherwise(F.col("id").cast("string")).alias("name"))
        for df in (bitmaps.id_counts(rows, "id", ["kind"]), bitmaps.repeated_ids(rows, "id", ["kind"]), heavy.top_values(rows, ["name"], 1, 64)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_domains_beyond_their_bound(spark, monkeypatch):
    monkeypatch.setattr(profiles, "DOMAIN", 2)
    values = ["a"] * 5 + ["b"] * 4 + ["c"] * 3 + ["d", " ", None] + [profiles.REST] * 9
    df = spark.createDataFrame([(v, "x") for v in values], "v string, w string").repartition(3)
    got = {r["column"]: r["domain"] for r in profiles.profile(df, "r", ["v", "w"], ["v", "w"], []).collect()}
    assert got == {"v": {profiles.REST: 9 + 8, "a": 5}, "w": {"x": len(values)}}


def test_summary_bounds():
    r = random.Random(5)
    values = [str(int(r.paretovariate(.7))) for _ in range(5000)]
    s = heavy.Summary(20)
    for at in range(0, len(values), 300):
        s.add(pa.array([*values[at:at + 300], None]))
    want = Counter(values)
    assert len(s.counts) <= 20 and s.error <= len(values) / 20
    assert all(s.counts.get(v, 0) <= n <= s.counts.get(v, 0) + s.error for v, n in want.items())


@pytest.mark.parametrize("counters", [8, 64, 5000])
def test_top_values_are_exact(spark, counters):
    r = random.Random(counters)
    rows = [(str(int(r.paretovariate(1.0))), str(k), r.choice(["a", "b", "", None]), None) for k in range(3000)]
    df = spark.createDataFrame(rows, "uneven string, unique string, few string, none string").repartition(3)
    got = {(x["field"], x["rank"]): (x["value"], x["n"]) for x in heavy.top_values(df, df.columns, 5, counters).collect()}
    for i, f in enumerate(df.columns):
        want = sorted(Counter(x[i] for x in rows if x[i]).items(), key=lambda v: (-v[1], v[0]))[:5]
        assert [got.get((f, k + 1)) for k in range(len(want))] == want and (f, len(want) + 1) not in got
    how = {x["field"]: x["by_summary"] for x in heavy.top_values(df, ["uneven", "unique"], 3, 64).collect()}
    assert how == {"uneven": True, "unique": False}
    assert heavy.top_values(df.limit(0), ["few"], 3).collect() == []


def test_profiles_merge_without_records(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    runs = [spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("2024-01-01").alias("day"), F.when(F.col("id") % 2 == 0, "a").alias("v")),
            spark.range(1000).select((F.col("id") + 500).cast("string").alias("k"), F.lit("2024-01-11").alias("day"), F.lit("b").alias("v")),
            spark.range(500).select(F.lit("1").alias("k"), F.lit("2024-06-01").alias("day"), F.lit("a").alias("v")),
            spark.range(0).select(F.lit("1").alias("k"), F.lit("2024-06-01").alias("day"), F.lit("a").alias("v"))]
    for i, rows in enumerate(runs):
        profiles.keep(store, profiles.profile(rows, f"r{i}", ["k", "day", "v"], ["v"], ["day"]), f"r{i}")
    with pytest.raises(AlreadyThere):
        profiles.keep(store, profiles.profile(runs[0], "r0", ["k", "day", "v"], ["v"], ["day"]), "r0")
    past = {r["column"]: r for r in profiles.merged(store.read(profiles.TABLE, keys=["r0", "r1"])).withColumn("d", F.hll_sketch_estimate("hll")).collect()}
    assert past["k"]["n"] == 2000 and abs(past["k"]["d"] - 1500) < 75 and past["v"]["domain"] == {"a": 500, "b": 1000} and past["v"]["nulls"] == 500
    d = {r["column"]: r for r in profiles.drift(store, "r2", ["r0", "r1"]).collect()}
    assert d["day"]["median_day_moved"] and d["k"]["distinct_moved"] and d["v"]["null_rate_moved"]
    assert d["v"]["gone_values"] == ["b"] and d["v"]["new_values"] == [] and d["k"]["row_count"] == 500 and d["k"]["history_rows"] == 2000
    empty = {r["column"]: r for r in profiles.drift(store, "r3", ["r0"]).collect()}
    assert empty["v"]["row_count"] == 0 and empty["v"]["null_rate"] is None


def test_lattice_of_every_selection(spark):
    ids = ["A", "B", "C"]
    combos = [("A", 5), ("A|B", 7), ("B|C", 1), ("", 4), ("A|B|C", 2), ("A", 1), ("OTHER", 9)]
    got = {tuple(r["rules"]): (r["any_of"], r["all_of"]) for r in archive.rule_lattice(spark.createDataFrame(combos, "combo string, cnt long"), ids).collect()}
    sets = [(set(c.split("|")), n) for c, n in combos]
    for s in range(1, 8):
        chosen = {x for i, x in enumerate(ids) if s >> i & 1}
        assert got[tuple(sorted(chosen))] == (sum(n for c, n in sets if c & chosen), sum(n for c, n in sets if chosen <= c))


def test_text_ids_are_dealt_out_before_they_are_grouped(spark, monkeypatch):
    """A task groups some `ROWS` ids whatever the size of the input's files."""
    import re
    monkeypatch.setattr(bitmaps, "ROWS", 100)
    rows = spark.createDataFrame([(t, f"x{i % 990}" if t == "a" else str(i % 990 * 10 ** 9)) for i in range(1000) for t in "ab"] + [("a", None)], "t string, id string")
    found = bitmaps.repeated_ids(rows, "id", ["t"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and re.search(r"hashpartitioning\(t#\d+, key_value#\d+, 21\)", plan)
    assert sorted(map(tuple, found.collect())) == sorted([("a", f"x{i}", 2) for i in range(10)] + [("b", str(i * 10 ** 9), 2) for i in range(10)])
    counted = {r["t"]: (r["ids"], r["distinct_ids"], r["duplicate_ids"]) for r in bitmaps.id_counts(rows, "id", ["t"]).collect()}
    assert counted == {"a": (1000, 990, 10), "b": (1000, 990, 10)}
