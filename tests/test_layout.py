"""Point lookups that skip files and row groups, joins of bucketed tables, bitmaps."""

import re

from pyspark.sql import functions as F

from ledgerline.plans.pipeline import Pipeline
from ledgerline.plans.q_core import bucketed_marts
from ledgerline.operators import marts
from ledgerline.sources import layout
from ledgerline.sources.store import Store
from conftest import SF_SMALL


def scanned_rows(df) -> int:
    """Rows that the file scans of a collected frame handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if "FileSourceScan" in node.getClass().getSimpleName():
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_lookup_reads_one_row_group(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    ids = F.format_string("%07d", F.col("id") * 3)
    rows = spark.range(60_000).select(F.when(F.col("id") % 1000 != 7, ids).alias("k"), F.md5(F.col("id").cast("string")).alias("v"), "id")
    table, ranges = layout.write_ranged(store, rows, "k", files=4, row_group=200_000)
    store.publish({"t": table, "t" + layout.RANGES: ranges})
    assert store.frame(ranges).agg(F.sum("n"), F.sum("nulls")).first()[:] == (60_000, 60)
    hit = layout.lookup(store, "t", "k", "0060000")
    assert [r["id"] for r in hit.collect()] == [20_000]
    assert len(hit.inputFiles()) == 1
    assert 0 < scanned_rows(layout.lookup(store, "t", "k", "0060000")) < 8_000           # of 15,000 in its file
    # between the keys of a row group: its Bloom filter, not its statistics, says no
    assert scanned_rows(layout.lookup(store, "t", "k", "0060001")) == 0
    assert layout.lookup(store, "t", "k", "zzz").collect() == []


def test_lookup_of_repeated_keys_and_empty_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)] + [("m", k) for k in range(100)], "k string, v int")
    for name, df in (("t", rows), ("none", rows.limit(0))):
        table, ranges = layout.write_ranged(store, df, "k", files=3)
        store.publish({name: table, name + layout.RANGES: ranges})
    assert sorted(r["v"] for r in layout.lookup(store, "t", "k", "a").collect()) == [1, 2]
    assert layout.lookup(store, "t", "k", "m").count() == 100
    assert layout.lookup(store, "none", "k", "a").collect() == []


def test_bucketed_marts_join_without_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None), spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    m = bucketed_marts(Pipeline.orders(spark, SF_SMALL), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = marts.case_join(m["fct"], m["signals"], m["queue"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        assert len(re.findall(r"SelectedBucketsCount: 4 out of 4", plan)) == 3
        assert joined.count() == m["fct"].count()
    finally:
        for name, value in zip(("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"), before):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert layout.drop_bucketed(spark) == 4
