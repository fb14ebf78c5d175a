"""Builders for hand-made raw frames (all-string source contract)."""

from __future__ import annotations

import datetime as dt

from ledgerline import fixed

RAW_NAMES = [n for n, _ in fixed.RAW_COLUMNS]

BASE = {
    "date_received": "2024-03-01", "product": "Mortgage", "sub_product": "Conventional",
    "issue": "Trouble paying", "sub_issue": "Late fee", "consumer_complaint_narrative": "",
    "company_public_response": "", "company": "Acme", "state": "CA", "zip_code": "94110", "tags": "",
    "submitted_via": "Web", "date_sent_to_company": "2024-03-02",
    "company_response_to_consumer": "Closed with explanation", "timely_response": "Yes", "complaint_id": "1",
}


def raw_frame(spark, rows: list[dict], snapshot: dt.date = dt.date(2024, 12, 31)):
    data = []
    for r in rows:
        full = dict(BASE)
        full.update(r)
        data.append(tuple(full[n] for n in RAW_NAMES) + (snapshot,))
    schema = ", ".join(f"{n} string" for n in RAW_NAMES) + ", source_snapshot_date date"
    return spark.createDataFrame(data, schema)
