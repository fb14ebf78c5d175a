import datetime as dt

from ledgerline.operators import archive


def _months(spark, values, start=(2020, 1)):
    y, m = start
    rows = []
    for v in values:
        rows.append((dt.date(y, m, 1), v))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return spark.createDataFrame(rows, "month date, value long")


def test_inflections_skip_first_points_and_small_previous(spark):
    # the jump at index 5 is ignored (first 13 points skipped); index 15 has a previous below 500
    vals = [1000] * 5 + [5000] + [1000] * 8 + [10, 1000, 1300, 1000]
    got = archive.inflections(_months(spark, vals), min_prev=500, limit=5).collect()
    assert [(r.value, r.previous) for r in got] == [(10, 1000), (1300, 1000), (1000, 1300)]
    assert [r.label for r in got] == ["-99% vs Feb 2021", "+30% vs Apr 2021", "-23% vs May 2021"]


def test_family_series_growth_share_and_trend(spark):
    fam = archive.family_dim(spark)
    rows = []
    for i in range(30):
        d = dt.date(2020 + (i // 12), i % 12 + 1, 1)
        rows.append((d, "AUTOMOBILE (LEGACY)", 10 if i < 10 else 0))
        rows.append((d, "AUTOMOBILE", 0 if i < 10 else 20))
        rows.append((d, "HOUSEHOLD", 5))
    mp = spark.createDataFrame(rows, "month date, product string, total long").filter("total > 0")
    r = {x.family_id: x for x in archive.family_series(mp, fam).collect()}
    auto = r["automobile"]
    # prior 12 months = 4 legacy months of 10 + 8 months of 20
    assert auto.total == 100 + 400 and auto.recent_12m == 240 and auto.prior_12m == 200
    assert abs(auto.change_pct - 0.2) < 1e-12 and auto.trend == "growing"
    assert auto.first_active == dt.date(2020, 1, 1) and abs(auto.growth_multiple - 2.0) < 1e-12
    assert abs(auto.share - 500 / 650) < 1e-12
    assert set(r) == {"automobile"}          # HOUSEHOLD is unmapped, never bucketed


def test_compare_periods_needs_two_full_windows(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, i), i) for i in range(1, 6)], "metric_date date, value long")
    assert archive.compare_periods(s, 3).count() == 0
    r = archive.compare_periods(s, 2).collect()[0]
    assert (r.current, r.previous, r.current_start, r.previous_end) == (9, 5, dt.date(2024, 1, 4),
                                                                         dt.date(2024, 1, 3))


def test_policy_overlap_diagonal_null(spark):
    combos = spark.createDataFrame([("AUTOMOBILE", "POLICY_EMERGING_ISSUE|POLICY_UNTIMELY_RESPONSE", 2),
                                    ("AUTOMOBILE", "POLICY_EMERGING_ISSUE", 6)],
                                   "product string, combo string, cnt long")
    fam = archive.family_dim(spark)
    ids = ["POLICY_EMERGING_ISSUE", "POLICY_UNTIMELY_RESPONSE"]
    got = {(r.row_id, r.col_id): r.share for r in archive.policy_overlap(combos, fam, None, ids).collect()}
    assert got[("POLICY_EMERGING_ISSUE", "POLICY_EMERGING_ISSUE")] is None
    assert abs(got[("POLICY_EMERGING_ISSUE", "POLICY_UNTIMELY_RESPONSE")] - 0.25) < 1e-12
    assert got[("POLICY_UNTIMELY_RESPONSE", "POLICY_EMERGING_ISSUE")] == 1.0
