"""The same answers by mechanisms that move less: bitmaps of ids, all grains from
one scan, heavy hitters by summaries, stored run profiles, the lattice of rule
selections (SRC-04, DQ-M, AG-08..26, TK-05, DQ-S, SET-05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions import round6
from ledgerline.operators import archive, bitmaps, heavy, profiles
from ledgerline.operators import exhibits as ex
from ledgerline.plans.oracle import orders_sql, snapshot_raw
from ledgerline.plans.pipeline import ArchivePipeline, Pipeline
from ledgerline.plans.q_core import r6
from ledgerline.plans.q_sources import RAW_NAMES, _scratch
from ledgerline.plans.registry import register
from ledgerline.sources.fixtures import SNAPSHOTS, orders_snapshot
from ledgerline.sources.sinks import staged
from ledgerline.sources.store import Store

# Ids of every kind: dense numerals, far-apart numerals, text, leading zeros; some missing, some doubled.
ID_KINDS = {
    "dense": "complaint_id",
    "sparse": "CAST(CAST(complaint_id AS bigint) * 1000003 AS string)",
    "text": "concat('C-', complaint_id)",
    "zeros": "concat('00', complaint_id)",
    "doubled": "CAST(CAST(complaint_id AS bigint) - CAST(complaint_id AS bigint) % 7 AS string)",
    "holes": "CASE WHEN CAST(complaint_id AS bigint) % 5 = 0 THEN NULL ELSE complaint_id END",
}
ID_ROWS_SQL = " UNION ALL ".join(f"SELECT '{k}' AS kind, {e} AS id FROM raw_cases" for k, e in ID_KINDS.items())


def _ids(spark, sf):
    raw = Pipeline.orders(spark, sf).raw
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.expr(e).alias("id")) for k, e in ID_KINDS.items()])).alias("p")
    return staged(raw.select("complaint_id").select(pairs).select("p.kind", "p.id"), "id-kinds")


@register("distinct_ids_by_bitmap", lambda: orders_sql(
    f"SELECT kind, count(id) AS ids, count(DISTINCT id) AS distinct_ids, count(id) - count(DISTINCT id) AS duplicate_ids FROM ({ID_ROWS_SQL}) GROUP BY kind"),
    ids="SRC-04 DQ-M SET-06 (bitmaps)")
def q_distinct_ids(spark, sf):
    return bitmaps.id_counts(_ids(spark, sf), "id", ["kind"])


@register("repeated_ids_by_bitmap", lambda: orders_sql(
    f"SELECT kind, id AS key_value, count(*) AS n FROM ({ID_ROWS_SQL}) WHERE id IS NOT NULL GROUP BY ALL HAVING n > 1"),
    ids="DQ-B SET-06 (bitmaps)")
def q_repeated_ids(spark, sf):
    return bitmaps.repeated_ids(_ids(spark, sf), "id", ["kind"])


SNAPSHOT_CTES = ", ".join(f"s{k} AS ({snapshot_raw(s)})" for k, s in enumerate(SNAPSHOTS))


@register("distinct_ids_of_runs", lambda: f"WITH {SNAPSHOT_CTES}, seen AS (" + " UNION ALL ".join(
    f"SELECT {k} AS run, complaint_id FROM s{k}" for k in range(3)) + ") SELECT r.run AS runs_up_to, (SELECT count(DISTINCT complaint_id) FROM seen WHERE run <= r.run) "
    "AS distinct_ids FROM (VALUES (0), (1), (2)) r(run)", ids="DQ-M SET-06 (bitmaps kept by run)")
def q_distinct_of_runs(spark, sf):
    """Distinct ids over several loads from the bitmap that each left."""
    store, out = Store(spark, _scratch(spark, "id-bitmaps")), None
    for k in range(3):
        store.append("ids", store.write(bitmaps.run_bitmaps(orders_snapshot(spark, sf, k), "complaint_id"), str(k)))
    for k in range(3):
        row = bitmaps.merged_distinct(store.read("ids", keys=[str(x) for x in range(k + 1)])).select(F.lit(k).alias("runs_up_to"), "distinct_ids")
        out = row if out is None else out.unionByName(row)
    return out


def _grains_sql() -> str:
    rows = "(SELECT *, CAST(date_trunc('month', complaint_received_date) AS date) AS month FROM decisions)"
    parts = []
    for g in [*ex.GRAINS, *ex.ROLLED]:
        keys = ", ".join(f"CAST({g[i]} AS varchar) AS k{i + 1}" if i < len(g) else f"CAST(NULL AS varchar) AS k{i + 1}" for i in range(3))
        group = f"GROUP BY {', '.join(g)}" if g else ""
        parts.append(f"SELECT '{'/'.join(g) or 'all'}' AS grain, {keys}, count(*) AS cnt FROM {rows} {group}")
    return orders_sql(" UNION ALL ".join(parts))


@register("all_grains_one_scan", _grains_sql, ids="AG-08 AG-09 AG-10 AG-11 AG-12 AG-13 AG-15 AG-16 AG-18 AG-23 AG-24 AG-25 AG-26 (one scan)")
def q_all_grains(spark, sf):
    return ex.all_grains(staged(ex.counted_grains(Pipeline.orders(spark, sf).wide), "grains"))


HEAVY = ["company", "product", "date_received", "complaint_id", "timely_response"]


def _heavy_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value FROM raw_cases WHERE {c} <> ''" for c in HEAVY)
    return (f"SELECT field, value, n, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS integer) AS rank "
            f"FROM (SELECT field, value, count(*) AS n FROM ({rows}) GROUP BY ALL)) WHERE rank <= 10")


@register("top_values_by_summary", lambda: orders_sql(_heavy_sql()), ids="TK-05 TK-01 (heavy hitters)")
def q_top_by_summary(spark, sf):
    """The ten first values of columns with few and with as many values as rows."""
    return heavy.top_values(Pipeline.orders(spark, sf).raw, HEAVY, 10).drop("by_summary")


# Records of the line items: more values than a summary holds, unevenly spread.
UNEVEN = "concat('Company ', CAST(CASE WHEN l_partkey % 4 = 0 THEN l_partkey % 11 ELSE l_partkey * 10 + l_linenumber END AS string))"


@register("top_companies_by_summary", lambda: (
    f"SELECT 'company' AS field, value, n, CAST(row_number() OVER (ORDER BY n DESC, value) AS integer) AS rank, true AS by_summary FROM (SELECT {UNEVEN} AS value, count(*) AS n "
    "FROM lineitem GROUP BY 1) ORDER BY rank LIMIT 8"), ids="AG-17 TK-05 (heavy hitters, long tail)")
def q_companies_by_summary(spark, sf):
    rows = spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet").select(F.expr(UNEVEN).alias("company"))
    return heavy.top_values(rows, ["company"], 8, counters=512)


PROFILED = ["complaint_id", "date_received", "product", "issue", "company_response_to_consumer", "tags", "state"]
DOMAIN_COLUMNS = ["product", "issue", "company_response_to_consumer", "tags", "state"]


def _profile_sql() -> str:
    parts = []
    for c in PROFILED:
        value, rate = f"nullif(trim({c}), '')", lambda t: f"(SELECT count_if(nullif(trim({c}), '') IS NULL) / CAST(count(*) AS double) FROM {t})"  # noqa: B023
        one = lambda a, b: (f"(SELECT ifnull(string_agg(v, '|' ORDER BY v), '') FROM (SELECT {value} AS v FROM {a} EXCEPT SELECT {value} FROM {b}) "  # noqa: B023, E731
                            "WHERE v IS NOT NULL)") if c in DOMAIN_COLUMNS else "''"  # noqa: B023
        distinct = lambda t: f"(SELECT count(DISTINCT {value}) FROM {t})"  # noqa: B023, E731
        day = lambda t: f"(SELECT median(datediff('day', DATE '1970-01-01', try_cast({c} AS date))) FROM {t})"  # noqa: B023, E731
        moved = f"abs({day('s2')} - {day('past')}) > 30" if c == "date_received" else "NULL"
        parts.append(f"""SELECT 'run-2' AS run_id, '{c}' AS "column", (SELECT count(*) FROM s2) AS row_count, (SELECT count(*) FROM past) AS history_rows,
          {r6(rate('s2'), 'null_rate')}, {r6(rate('past'), 'history_null_rate')}, {one('s2', 'past')} AS new_values, {one('past', 's2')} AS gone_values,
          abs({rate('s2')} - {rate('past')}) > 0.01 AS null_rate_moved, abs({distinct('s2')} / {distinct('past')} - 1) > 0.25 AS distinct_moved,
          {moved} AS median_day_moved""")
    return f"WITH {SNAPSHOT_CTES}, past AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1) " + " UNION ALL ".join(parts)


@register("profile_drift", _profile_sql, ids="DQ-L DQ-M DQ-N DQ-O DQ-P DQ-S (profiles kept by run)")
def q_profile_drift(spark, sf):
    """The third load against the first two, from the profiles that each left."""
    store = Store(spark, _scratch(spark, "profiles"))
    for k in range(3):
        rows = orders_snapshot(spark, sf, k).select(*RAW_NAMES)
        profiles.keep(store, profiles.profile(rows, f"run-{k}", PROFILED, DOMAIN_COLUMNS, ["date_received"]), f"run-{k}")
    d = profiles.drift(store, "run-2", ["run-0", "run-1"])
    return d.withColumns({"null_rate": round6("null_rate"), "history_null_rate": round6("history_null_rate"),
                          "new_values": F.array_join("new_values", "|"), "gone_values": F.array_join("gone_values", "|")})


RULES = sorted(fixed.POLICY_IDS)


def _lattice_sql() -> str:
    # a selection's rules as a list, every record held against every selection
    ids = "[" + ", ".join(f"'{x}'" for x in RULES) + "]"
    return orders_sql(f""", selections AS (SELECT s, list_filter({ids}, lambda x, i: (s >> (i - 1)) & 1 = 1) AS rules FROM range(1, {1 << len(RULES)}) r(s))
      SELECT CAST(s AS integer) AS selection, array_to_string(rules, '|') AS rules, count(*) FILTER (list_has_any(policy_ids, rules)) AS any_of,
        count(*) FILTER (list_has_all(policy_ids, rules)) AS all_of FROM selections, cases0 GROUP BY ALL""")


@register("rule_lattice", _lattice_sql, ids="SET-05 DEC-17 DEC-18 (all selections)")
def q_rule_lattice(spark, sf):
    return archive.rule_lattice(ArchivePipeline.orders(spark, sf).combos, RULES).withColumn("rules", F.array_join("rules", "|"))


