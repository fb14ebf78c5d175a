"""Month-grain archive analytics (AG-36..39, W-07..W-16, TK-02..TK-04,
DEC-14..DEC-20, JN-13, SET-05).

Inputs are the month-grain exhibits (month x product, month x product x
issue, issue movement, policy-by-product, policy combinations, company
outcomes), i.e. already-aggregated frames.  Family scoping is a left-semi
join against the family dimension, which is a fixed, hand-written table
(broadcast is size-safe).  Series windows run over month rows, whose count
is bounded by the calendar (12 per year), not by record volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import safe_divide


def family_dim(spark: SparkSession, families=fixed.FIXTURE_FAMILIES) -> DataFrame:
    rows = [(fid, label, member) for fid, label, members in families for member in members]
    return spark.createDataFrame(rows, "family_id string, family_label string, product string")


def with_family(df: DataFrame, fam: DataFrame) -> DataFrame:
    """JN-13: label -> family; unmapped labels keep a NULL family (surfaced, not bucketed)."""
    return df.join(F.broadcast(fam), "product", "left")


def unmapped_labels(mp: DataFrame, fam: DataFrame) -> DataFrame:
    """JN-13 gap report / DQ-U: labels with no family, with their volume."""
    return (mp.join(F.broadcast(fam.select("product")), "product", "left_anti")
              .groupBy("product").agg(F.sum("total").alias("total")))


def in_scope(df: DataFrame, fam: DataFrame, family_id: str | None) -> DataFrame:
    """Rows whose product belongs to the family (all rows when family_id is None)."""
    if family_id is None:
        return df
    members = fam.filter(F.col("family_id") == family_id).select("product")
    return df.join(F.broadcast(members), "product", "left_semi")


def archive_months(mp: DataFrame) -> DataFrame:
    """AG-38: every month present, with its total across products."""
    return mp.groupBy("month").agg(F.sum("total").alias("total"))


def _months_w() -> Window:
    # One ordered partition of month rows (calendar-bounded).
    return Window.orderBy("month")


def running_total(mp: DataFrame) -> DataFrame:
    """W-07: cumulative archive volume by month."""
    w = _months_w().rowsBetween(Window.unboundedPreceding, 0)
    return archive_months(mp).withColumn("cumulative", F.sum("total").over(w))


def scope_series(mp: DataFrame, fam: DataFrame, family_id: str | None) -> DataFrame:
    """Monthly points of a scope over every archive month (zero where the
    scope has no volume): months left-joined to the scope's month totals."""
    months = mp.select("month").distinct()
    vals = in_scope(mp, fam, family_id).groupBy("month").agg(F.sum("total").alias("v"))
    return months.join(vals, "month", "left").select("month", F.coalesce("v", F.lit(0)).alias("value"))


def inflections(points: DataFrame, min_prev: int = 500, min_abs: float = 0.2, skip: int = 13,
                limit: int = 1) -> DataFrame:
    """W-08: largest month-over-month moves, ignoring the first `skip` points."""
    w = _months_w()
    moves = (points.withColumn("_i", F.row_number().over(w) - 1)
                   .withColumn("previous", F.lag("value").over(w))
                   .withColumn("previous_month", F.lag("month").over(w))
                   .filter((F.col("_i") >= skip) & (F.col("previous") >= min_prev))
                   .withColumn("change_pct", (F.col("value") - F.col("previous")) / F.col("previous"))
                   .filter(F.abs("change_pct") >= min_abs))
    label = F.concat(F.when(F.col("change_pct") > 0, "+").otherwise(""),
                     F.floor(F.col("change_pct") * 100 + 0.5).cast("string"), F.lit("% vs "),
                     F.date_format("previous_month", "MMM yyyy"))
    return (moves.select("month", "value", "previous", "change_pct", label.alias("label"))
                 .orderBy(F.desc(F.abs("change_pct")), F.asc("month")).limit(limit))


def family_series(mp: DataFrame, fam: DataFrame) -> DataFrame:
    """DEC-14/15, W-09/W-10, W-15, TK-04: per family total, trailing 12 vs
    prior 12 archive months, change, growth multiple, share, first/last
    active month, trend class and rank by total."""
    months = mp.select("month").distinct().withColumn(
        "_r", F.row_number().over(Window.orderBy(F.desc("month"))))
    fm = (mp.join(F.broadcast(fam), "product").groupBy("family_id", "family_label", "month")
            .agg(F.sum("total").alias("v"))
            .join(months, "month"))
    archive_total = mp.agg(F.sum("total")).scalar()   # scalar subquery
    r, v = F.col("_r"), F.col("v")
    agg = fm.groupBy("family_id", "family_label").agg(
        F.sum(v).alias("total"),
        F.sum(F.when(r <= 12, v).otherwise(0)).alias("recent_12m"),
        F.sum(F.when((r > 12) & (r <= 24), v).otherwise(0)).alias("prior_12m"),
        F.min(F.when(v > 0, F.col("month"))).alias("first_active"),
        F.max(F.when(v > 0, F.col("month"))).alias("last_active"),
        F.min_by(F.when(v > 0, v), F.when(v > 0, F.col("month"))).alias("_first_value"),
        F.sum(F.when(r == 1, v).otherwise(0)).alias("_last_value"),
    ).filter(F.col("total") != 0)
    change = F.when(F.col("prior_12m") > 0,
                    (F.col("recent_12m") - F.col("prior_12m")) / F.col("prior_12m"))
    growth = F.when((F.col("_first_value") > 0) & (F.col("_last_value") > 0),
                    F.col("_last_value") / F.col("_first_value"))
    out = (agg.withColumn("change_pct", change).withColumn("growth_multiple", growth)
              .withColumn("share", F.when(archive_total > 0, F.col("total") / archive_total).otherwise(0.0)))
    out = out.withColumn("trend", trend_class(F.col("recent_12m"), F.col("prior_12m"), F.col("change_pct")))
    out = out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), F.asc("family_id"))))
    return out.select("family_id", "family_label", "total", "recent_12m", "prior_12m", "change_pct",
                      "growth_multiple", "share", "first_active", "last_active", "trend", "rank")


def trend_class(recent: Column, prior: Column, change: Column) -> Column:
    """DEC-15."""
    return (F.when(recent == 0, fixed.TREND_ENDED).when(prior == 0, fixed.TREND_NEW)
             .when(change.isNotNull() & (change > 0.1), fixed.TREND_GROWING)
             .when(change.isNotNull() & (change < -0.1), fixed.TREND_DECLINING)
             .otherwise(fixed.TREND_STEADY))


def compare_periods(series: DataFrame, n: int, date_col: str = "metric_date") -> DataFrame:
    """W-11: last n points vs the n before; no row when the series is shorter than 2n."""
    w = Window.orderBy(F.desc(date_col))
    ranked = series.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2 * n)
    cur = F.col("_r") <= n
    d, v = F.col(date_col), F.col("value")
    out = ranked.agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(cur, v).otherwise(0)).alias("current"),
        F.sum(F.when(~cur, v).otherwise(0)).alias("previous"),
        F.min(F.when(cur, d)).alias("current_start"), F.max(F.when(cur, d)).alias("current_end"),
        F.min(F.when(~cur, d)).alias("previous_start"), F.max(F.when(~cur, d)).alias("previous_end"))
    return (out.filter(F.col("_n") >= 2 * n)
               .withColumn("change_pct", F.when(F.col("previous") > 0,
                                                (F.col("current") - F.col("previous")) / F.col("previous")))
               .withColumn("current_days", F.lit(n)).drop("_n"))


def focused_month(mpi: DataFrame, fam: DataFrame, month: str, family_id: str | None, k: int = 8) -> DataFrame:
    """W-12: issues of `month` (YYYY-MM) vs the previous month, top k by
    volume, with both month totals."""
    m = F.to_date(F.lit(month + "-01"))
    rows = in_scope(mpi, fam, family_id).filter((F.col("month") == m) | (F.col("month") == F.add_months(m, -1)))
    is_cur = F.col("month") == m
    by_issue = rows.groupBy("issue").agg(
        F.sum(F.when(is_cur, F.col("total")).otherwise(0)).alias("total"),
        F.sum(F.when(~is_cur, F.col("total")).otherwise(0)).alias("previous"),
        F.max(is_cur.cast("int")).alias("_in_cur"))
    month_total = rows.agg(F.sum(F.when(is_cur, F.col("total")).otherwise(0))).scalar()
    previous_total = rows.agg(F.sum(F.when(~is_cur, F.col("total")).otherwise(0))).scalar()
    top = by_issue.filter(F.col("_in_cur") == 1).drop("_in_cur").orderBy(F.desc("total"), F.asc("issue")).limit(k)
    return top.select(F.lit(month).alias("month"), "issue", "total", "previous",
                      month_total.alias("month_total"), previous_total.alias("previous_month_total"))


def peak(points: DataFrame) -> DataFrame:
    """W-13: the first month holding the maximum value."""
    return points.orderBy(F.desc("value"), F.asc("month")).limit(1).select("month", "value")


def trailing_12(points: DataFrame, cumulative: bool = False) -> DataFrame:
    """W-14: trailing-12 volume; on the cumulative curve, end minus the point
    12 positions earlier (or the first point)."""
    w = Window.orderBy(F.desc("month"))
    r = points.withColumn("_r", F.row_number().over(w))
    if not cumulative:
        return r.filter(F.col("_r") <= 12).agg(F.sum("value").alias("trailing_12"))
    start_r = F.least(F.lit(13), points.agg(F.count(F.lit(1))).scalar())
    return r.agg((F.sum(F.when(F.col("_r") == 1, F.col("value")).otherwise(0))
                  - F.sum(F.when(F.col("_r") == start_r, F.col("value")).otherwise(0))).alias("trailing_12"))


def recent_share(mp: DataFrame, fam: DataFrame, family_id: str | None) -> DataFrame:
    """W-16: share of the scope's volume that arrived in the last 12 archive months."""
    months = mp.select("month").distinct().withColumn("_r", F.row_number().over(Window.orderBy(F.desc("month"))))
    s = in_scope(mp, fam, family_id).join(months, "month")
    return (s.agg(F.sum(F.when(F.col("_r") <= 12, F.col("total")).otherwise(0)).alias("recent_12m"),
                  F.sum("total").alias("scope_total"))
             .withColumn("recent_share", safe_divide("recent_12m", "scope_total")))


def dimension_mix(rows: DataFrame, fam: DataFrame, family_id: str | None, value_col: str,
                  n: int = 8) -> DataFrame:
    """TK-02: per-value volume in scope, top n, share over all values in scope."""
    per = in_scope(rows, fam, family_id).groupBy(F.col(value_col).alias("value")).agg(F.sum("cnt").alias("count"))
    grand = per.agg(F.sum("count")).scalar()
    top = per.orderBy(F.desc("count"), F.asc("value")).limit(n)
    return top.withColumn("share", F.when(grand > 0, F.col("count") / grand).otherwise(0.0))


def issue_contributions(mov: DataFrame, fam: DataFrame, family_id: str | None, k: int = 6) -> DataFrame:
    """TK-03: which issues drove the change; contribution = delta / total delta."""
    per = (in_scope(mov, fam, family_id).groupBy("issue")
           .agg(F.sum("current_12m").alias("current"), F.sum("prior_12m").alias("prior"))
           .withColumn("delta", F.col("current") - F.col("prior"))
           .withColumn("change_pct", F.when(F.col("prior") > 0, F.col("delta") / F.col("prior"))))
    tot = per.agg(F.sum("delta")).scalar()
    top = per.orderBy(F.desc(F.abs("delta")), F.asc("issue")).limit(k)
    return (top.withColumn("total_delta", tot)
               .withColumn("contribution", F.when(F.col("total_delta") != 0,
                                                  F.col("delta") / F.col("total_delta")).otherwise(0.0)))


def policy_rates(pbp: DataFrame, fam: DataFrame, family_id: str | None) -> DataFrame:
    """DEC-16: per policy triggered / evaluated, the denominator summed once
    per product (not once per policy row)."""
    s = in_scope(pbp, fam, family_id)
    evaluated = s.groupBy("product").agg(F.max("evaluated_count").alias("e")).agg(F.sum("e")).scalar()
    trig = s.groupBy("policy_id").agg(F.sum("triggered_count").alias("triggered"))
    return (trig.withColumn("evaluated", evaluated)
                .withColumn("rate", F.when(F.col("evaluated") > 0, F.col("triggered") / F.col("evaluated"))))


def _policies(combo: Column) -> Column:
    from ledgerline.functions import combo_policies
    return combo_policies(combo)


def rule_coverage(combos: DataFrame, fam: DataFrame, family_id: str | None, selected: list[str]) -> DataFrame:
    """DEC-17 / SET-05: exact union counts over the policy-set partition."""
    s = in_scope(combos, fam, family_id).withColumn("_p", _policies(F.col("combo")))
    none = F.size("_p") == 0
    sel = F.arrays_overlap("_p", F.array(*[F.lit(x) for x in selected]).cast("array<string>"))
    return s.agg(F.sum(F.when(~none & sel, F.col("cnt")).otherwise(0)).alias("selected"),
                 F.sum(F.when(~none, F.col("cnt")).otherwise(0)).alias("any_rule"),
                 F.sum(F.when(none, F.col("cnt")).otherwise(0)).alias("no_rule"),
                 F.sum("cnt").alias("evaluated"))


def per_rule(combos: DataFrame, fam: DataFrame, family_id: str | None) -> DataFrame:
    """DEC-17 perRule: exact count per individual rule."""
    s = in_scope(combos, fam, family_id).select(F.explode(_policies(F.col("combo"))).alias("policy_id"), "cnt")
    return s.groupBy("policy_id").agg(F.sum("cnt").alias("count"))


def policy_overlap(combos: DataFrame, fam: DataFrame, family_id: str | None, ids: list[str]) -> DataFrame:
    """DEC-18: share of the row rule's records that also trip the column rule
    (diagonal NULL).  Pairs are formed inside one combination's own policy
    array (at most five rules), never across records."""
    s = in_scope(combos, fam, family_id).select(_policies(F.col("combo")).alias("_p"), "cnt")
    totals = s.select(F.explode("_p").alias("row_id"), "cnt").groupBy("row_id").agg(F.sum("cnt").alias("total"))
    pairs = (s.select(F.explode("_p").alias("row_id"), "_p", "cnt")
              .select("row_id", F.explode("_p").alias("col_id"), "cnt")
              .filter(F.col("row_id") != F.col("col_id"))
              .groupBy("row_id", "col_id").agg(F.sum("cnt").alias("both")))
    grid = F.explode(F.array(*[F.lit(x) for x in ids]))
    spark = combos.sparkSession
    axis = spark.range(1).select(grid.alias("row_id")).select("row_id", grid.alias("col_id"))  # ids x ids literal
    out = (axis.join(F.broadcast(totals), "row_id", "left").join(F.broadcast(pairs), ["row_id", "col_id"], "left")
               .withColumn("total", F.coalesce("total", F.lit(0))))
    share = F.when((F.col("row_id") == F.col("col_id")) | (F.col("total") == 0), F.lit(None).cast("double")) \
             .otherwise(F.coalesce("both", F.lit(0)) / F.col("total"))
    return out.select("row_id", "col_id", "total", share.alias("share"))


def weekend_share(rhythm: DataFrame) -> DataFrame:
    """DEC-19: average weekend day over average weekday (0 when either is missing)."""
    we = F.col("day_name").isin("Sat", "Sun")
    r = rhythm.agg(F.avg(F.when(we, F.col("avg_total"))).alias("weekend_avg"),
                   F.avg(F.when(~we, F.col("avg_total"))).alias("weekday_avg"))
    return r.withColumn("weekend_share", F.coalesce(F.col("weekend_avg") / F.col("weekday_avg"), F.lit(0.0)))


def with_markers(points: DataFrame, markers: list[tuple[str, str]]) -> DataFrame:
    """DEC-20: taxonomy-change markers joined to a month series."""
    spark = points.sparkSession
    mk = spark.createDataFrame(markers, "marker_month string, marker_label string")
    return points.join(F.broadcast(mk), F.date_format("month", "yyyy-MM") == F.col("marker_month"), "left") \
                 .drop("marker_month")


def company_rollup(co: DataFrame, fam: DataFrame, family_id: str | None, k: int = 12) -> DataFrame:
    """AG-39: handling companies over the family, top k with outcome sums.  `co`
    holds every company of every product (`company_outcomes` with k None): a
    company cut from one product's list would be short in the sum."""
    agg = (in_scope(co, fam, family_id).groupBy("company")
           .agg(F.sum("cnt").alias("count"), F.sum("explanation_cnt").alias("explanation"),
                F.sum("monetary_cnt").alias("monetary"), F.sum("nonmonetary_cnt").alias("non_monetary"),
                F.sum("untimely_cnt").alias("untimely")))
    return agg.orderBy(F.desc("count"), F.asc("company")).limit(k)


def rule_lattice(combos: DataFrame, ids: list[str]) -> DataFrame:
    """SET-05, DEC-17, DEC-18 for every selection of rules at once: (selection, a
    bit for each of `ids`; rules; any_of, records that trip at least one of them;
    all_of, records that trip all).

    Records are counted by their exact set of rules first, a bit mask, so 2^len(ids)
    rows stand for all of them; each of these is then held against each selection by
    its bits."""
    rules, every = F.split("combo", f"[{fixed.COMBO_SEP}]"), F.sequence(F.lit(1), F.lit((1 << len(ids)) - 1))
    mask = sum((F.when(F.array_contains(rules, x), 1 << i).otherwise(0) for i, x in enumerate(ids)), F.lit(0))
    by_set = combos.groupBy(mask.alias("mask")).agg(F.sum("cnt").alias("c"))
    both = F.col("mask").bitwiseAND(F.col("selection"))
    total = lambda hit: F.coalesce(F.sum(F.when(hit, F.col("c"))), F.lit(0))
    named = F.array_compact(F.array(*[F.when(F.col("selection").bitwiseAND(F.lit(1 << i)) > 0, F.lit(x)) for i, x in enumerate(ids)]))
    return (by_set.withColumn("selection", F.explode(every)).groupBy("selection")
            .agg(total(both > 0).alias("any_of"), total(both == F.col("selection")).alias("all_of"))
            .select("selection", named.alias("rules"), "any_of", "all_of"))
