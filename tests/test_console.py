import datetime as dt

from ledgerline.operators import console


def test_with_pct_rounds_to_one_decimal(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "k string, cnt long")
    got = {r.k: r.pct for r in console.with_pct(df, "k").collect()}
    assert got == {"A": 16.7, "B": 33.3, "C": 50.0}


def test_pivot_is_zero_filled_over_the_closed_domain(spark):
    s = spark.createDataFrame([("HIGH", "MEDIUM", 3), ("LOW", "HIGH", 5)],
                              "priority string, signal_confidence string, cnt long")
    rows = {r.priority: r.asDict() for r in console.pivot_counts(s, "priority", "signal_confidence").collect()}
    assert rows["HIGH"]["MEDIUM"] == 3 and rows["HIGH"]["HIGH"] == 0 and rows["HIGH"]["NOT_SUPPORTED"] == 0
    assert rows["LOW"]["HIGH"] == 5


def test_metric_bundle_zero_fills_and_drops_single_date_metrics(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    m = spark.createDataFrame([(d1, "A", "vol", 5), (d2, "B", "vol", 7), (d1, "X", "snap", 1)],
                              "metric_date date, dashboard_dimension string, metric_name string, metric_value long")
    got = {(r.metric_date, r.dashboard_dimension): (r.value, r.dimension_rank)
           for r in console.metric_bundle(m).collect()}
    assert got == {(d1, "A"): (5, 2), (d2, "A"): (0, 2), (d1, "B"): (0, 1), (d2, "B"): (7, 1)}
