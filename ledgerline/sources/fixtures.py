"""Adapters that shape the driver's tables into the raw complaint contract.

`orders_raw_cases` maps one order to one complaint record (FIXTURES.md §3);
`events_raw_cases` maps one event to one record for dense daily series.
Both return the 16 all-string source columns plus `source_snapshot_date`.
The same shaping exists as DuckDB SQL in `ledgerline.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixed


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(c: str, n: int):
    return F.col(c) % n == 0


def orders_raw_cases(spark: SparkSession, sf_dir: str,
                     snapshot: dt.date = dt.date(2001, 8, 1)) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is a fixed 25-row table: broadcasting it is size-safe.
    n = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    k = "o_orderkey"
    day = F.col("o_orderdate").cast("date").cast("string")
    status = F.col("o_orderstatus")
    return j.select(
        day.alias("date_received"),
        F.when((F.col("c_mktsegment") == "AUTOMOBILE")
               & (F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")),
               F.lit("AUTOMOBILE (LEGACY)")).otherwise(F.col("c_mktsegment")).alias("product"),
        F.when(_mod(k, 73), "").otherwise(F.col("n_name")).alias("sub_product"),
        F.when(_mod(k, 1501), "").otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"))).alias("issue"),
        F.when(_mod(k, 19), "").otherwise(
            F.concat(F.lit("sub-"), (F.col("o_custkey") % 7).cast("string"))).alias("sub_issue"),
        F.when(_mod(k, 4), 'free text, with "quotes"').otherwise("").alias("consumer_complaint_narrative"),
        F.when(_mod(k, 5), "None").when(F.col(k) % 5 == 1, "")
         .otherwise("No public response").alias("company_public_response"),
        F.concat(F.lit("Company "), (F.col("o_custkey") % 40).cast("string")).alias("company"),
        F.when(_mod(k, 211), "").when(_mod(k, 197), "LONG")
         .otherwise(F.upper(F.substring("n_name", 1, 2))).alias("state"),
        F.when(_mod(k, 13), "064XX").otherwise("06401").alias("zip_code"),
        F.when(_mod(k, 21), "Servicemember").when(F.col(k) % 21 == 1, "None").otherwise("").alias("tags"),
        F.when(_mod(k, 29), "Phone").when(_mod(k, 31), "Fax").otherwise("Web").alias("submitted_via"),
        day.alias("date_sent_to_company"),
        F.when(_mod(k, 811), "")
         .when((status == "O") & _mod(k, 10), "In progress")
         .when(status == "O", "Closed with explanation")
         .when(status == "F", "Closed with non-monetary relief")
         .otherwise("Closed with monetary relief").alias("company_response_to_consumer"),
        F.when(_mod(k, 25), "No").otherwise("yes ").alias("timely_response"),
        F.col(k).cast("string").alias("complaint_id"),
        F.lit(snapshot).alias("source_snapshot_date"),
    )


def events_raw_cases(spark: SparkSession, sf_dir: str,
                     snapshot: dt.date = dt.date(2024, 6, 1)) -> DataFrame:
    """One event -> one record: product = event type, issue = value band 0..3."""
    e = _read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    day = F.col("ts").cast("date").cast("string")
    band = F.least(F.floor(F.col("value") / F.lit(122.5)), F.lit(3)).cast("bigint").cast("string")
    cols = {name: F.lit("") for name, _ in fixed.RAW_COLUMNS}
    cols.update({
        "date_received": day,
        "product": F.col("event_type"),
        "sub_product": F.col("event_type"),
        "issue": band,
        "sub_issue": band,
        "company": F.lit("Company 0"),
        "submitted_via": F.lit("Web"),
        "date_sent_to_company": day,
        "company_response_to_consumer": F.lit("Closed with explanation"),
        "timely_response": F.lit("Yes"),
        "complaint_id": F.col("event_id").cast("string"),
    })
    return e.select(*[cols[n].alias(n) for n, _ in fixed.RAW_COLUMNS],
                    F.lit(snapshot).alias("source_snapshot_date"))


def lineitem_raw_cases(spark: SparkSession, sf_dir: str, snapshot: dt.date) -> DataFrame:
    """One line item -> one record: product = return flag, one issue, dense over
    the ship dates, so that the default windows and volumes are reached."""
    e = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_partkey", "l_suppkey")
    day = F.col("l_shipdate").cast("date").cast("string")
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    cols = {name: F.lit("") for name, _ in fixed.RAW_COLUMNS}
    cols.update({
        "date_received": day,
        "product": F.concat(F.lit("Flag "), F.col("l_returnflag")),
        "sub_product": F.when(k % 50 == 1, "").otherwise("Line item"),
        "issue": F.lit("Shipment"),
        "sub_issue": F.lit("Any"),
        "company": F.concat(F.lit("Company "), (F.col("l_orderkey") % 40).cast("string")),
        "state": F.lit("CA"),
        "submitted_via": F.lit("Web"),
        "date_sent_to_company": day,
        "company_response_to_consumer": F.lit("Closed with explanation"),
        "timely_response": F.when(k % 20 == 1, "No").otherwise("Yes"),
        "complaint_id": F.concat_ws("-", k, "l_partkey", "l_suppkey", day),
    })
    return e.select(*[cols[n].alias(n) for n, _ in fixed.RAW_COLUMNS], F.lit(snapshot).alias("source_snapshot_date"))


#: Three landed snapshots of the orders fixture: date, which records it holds and
#: what it has corrected (column -> SQL that Spark and DuckDB both read).
_ID = "CAST(complaint_id AS bigint)"
SNAPSHOTS = [
    (dt.date(2001, 8, 1), f"{_ID} % 17 <> 0", {}),
    (dt.date(2001, 9, 1), f"{_ID} % 34 <> 0 AND {_ID} % 23 <> 0", {
        "company_response_to_consumer": f"CASE WHEN company_response_to_consumer = 'In progress' AND {_ID} % 3 <> 0 "
                                        "THEN 'Closed with explanation' ELSE company_response_to_consumer END",
        "issue": f"CASE WHEN {_ID} % 41 = 0 THEN ' 5-LOW' ELSE issue END"}),
    (dt.date(2001, 10, 1), f"{_ID} % 23 <> 1", {
        "company_response_to_consumer": "CASE WHEN company_response_to_consumer = 'In progress' THEN 'Closed with monetary relief' "
                                        "ELSE company_response_to_consumer END",
        "date_received": f"CASE WHEN {_ID} % 43 = 0 THEN CAST(CAST(date_received AS date) + 3 AS string) ELSE date_received END"}),
]


#: A landed snapshot that corrects only records received since a day.
_LATE = "date_received >= '2001-04-01'"
LATE_SNAPSHOTS = [
    (dt.date(2001, 8, 1), f"NOT ({_LATE} AND {_ID} % 13 = 0)", {}),
    (dt.date(2001, 8, 20), f"NOT ({_LATE} AND {_ID} % 19 = 0)", {
        "company_response_to_consumer": f"CASE WHEN {_LATE} AND company_response_to_consumer = 'In progress' THEN 'Closed with explanation' "
                                        "ELSE company_response_to_consumer END",
        "timely_response": f"CASE WHEN {_LATE} AND {_ID} % 29 = 0 THEN 'No' ELSE timely_response END"}),
]


def orders_snapshot(spark: SparkSession, sf_dir: str, k: int, snapshots: list[tuple] = SNAPSHOTS) -> DataFrame:
    date, held, corrected = snapshots[k]
    rows = orders_raw_cases(spark, sf_dir, date).filter(F.expr(held))
    return rows.withColumns({c: F.expr(sql) for c, sql in corrected.items()})
