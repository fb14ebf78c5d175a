import datetime as dt

from helpers import raw_frame
from pyspark.sql import functions as F

from ledgerline.operators import archive, marts, quality
from ledgerline.params import Params
from ledgerline.plans.pipeline import Pipeline

P = Params(cur=7, base=30, min_cur=1, min_base=1, snapshot_date=dt.date(2024, 12, 31), as_of=dt.date(2024, 12, 31))


def test_taxonomy_join_matches_null_subfields(spark):
    raw = raw_frame(spark, [{"complaint_id": "1", "sub_product": ""}, {"complaint_id": "2"}])
    pl = Pipeline(raw, P, materialize=False)
    joined = {r.complaint_id: r.issue_taxonomy_key for r in marts.attach_taxonomy(pl.records, pl.dim).collect()}
    direct = {r.complaint_id: r.issue_taxonomy_key for r in pl.fct.collect()}
    assert joined == direct and all(v is not None for v in joined.values())
    assert joined["1"] != joined["2"]


def test_duplicate_count_excludes_nulls(spark):
    raw = raw_frame(spark, [{"complaint_id": "1"}, {"complaint_id": "1"}, {"complaint_id": ""},
                            {"complaint_id": ""}, {"complaint_id": "2"}])
    prof = {r.metric: r.value for r in quality.profile(raw).collect()}
    assert prof["duplicate_ids"] == 1 and prof["null_count:complaint_id"] == 2 and prof["unique_ids"] == 2
    staged = Pipeline(raw, P, materialize=False).staged
    assert [r.complaint_id for r in quality.unique(staged, "complaint_id").collect()] == ["1"]


def test_singular_checks_pass_on_pipeline(spark):
    raw = raw_frame(spark, [{"complaint_id": str(i), "timely_response": "No" if i % 3 else "Yes"}
                            for i in range(30)])
    pl = Pipeline(raw, P, materialize=False)
    assert quality.critical_without_trigger(pl.queue).count() == 0
    assert quality.reason_required(pl.queue).count() == 0
    assert quality.daily_reconciles(pl.fdm, pl.records).count() == 0
    assert quality.dropped_bounded(pl.raw, pl.staged).count() == 0


def test_unmapped_label_is_reported(spark):
    mp = spark.createDataFrame([(dt.date(2024, 1, 1), "AUTOMOBILE", 5), (dt.date(2024, 1, 1), "HOUSEHOLD", 7)],
                               "month date, product string, total long")
    fam = archive.family_dim(spark)
    assert [tuple(r) for r in archive.unmapped_labels(mp, fam).collect()] == [("HOUSEHOLD", 7)]
    fams = {r.product: r.family_id for r in archive.with_family(mp, fam).collect()}
    assert fams == {"AUTOMOBILE": "automobile", "HOUSEHOLD": None}


def test_trend_classes(spark):
    df = spark.createDataFrame([(0, 0, None), (5, 0, None), (120, 100, 0.2), (80, 100, -0.2), (100, 100, 0.0)],
                               "recent long, prior long, change double")
    got = [r.t for r in df.select(archive.trend_class(F.col("recent"), F.col("prior"), F.col("change"))
                                  .alias("t")).collect()]
    assert got == ["ended", "new", "growing", "declining", "steady"]


def test_rule_coverage_stable_only_combo_is_no_rule(spark):
    combos = spark.createDataFrame([("AUTOMOBILE", "POLICY_STABLE_PATTERN", 10),
                                    ("AUTOMOBILE", "POLICY_EMERGING_ISSUE|POLICY_INCOMPLETE_CONTEXT", 4),
                                    ("AUTOMOBILE", "POLICY_UNTIMELY_RESPONSE", 3)],
                                   "product string, combo string, cnt long")
    fam = archive.family_dim(spark)
    r = archive.rule_coverage(combos, fam, "automobile", ["POLICY_EMERGING_ISSUE"]).collect()[0]
    assert (r.selected, r.any_rule, r.no_rule, r.evaluated) == (4, 7, 10, 17)


def test_config_parity_reports_differences():
    seed = {"current_window_days": 7, "baseline_window_days": 30, "min_current_volume": 20,
            "min_baseline_volume": 50, "minimum_pct_change": 0.30}
    assert quality.config_parity(Params(), seed) == []
    diff = quality.config_parity(Params(cur=28, base=120, min_cur=4, min_base=4), seed)
    assert [d[0] for d in diff] == ["current_window_days", "baseline_window_days", "min_current_volume",
                                    "min_baseline_volume"]


def test_salted_trend_join_equals_plain(spark):
    from ledgerline.operators import marts as m
    raw = raw_frame(spark, [{"complaint_id": str(i), "issue": "A" if i % 3 else "B",
                             "date_received": f"2024-03-{1 + i % 5:02d}"} for i in range(60)])
    pl = Pipeline(raw, P, materialize=False)
    a = sorted(tuple(r) for r in m.attach_trend(pl.records, pl.trends).collect())
    salted = m.attach_trend(pl.records, pl.trends, salt_buckets=4)
    assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()
    b = sorted(tuple(r) for r in salted.collect())
    assert a == b and len(a) == 60
