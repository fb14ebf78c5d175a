import datetime as dt

from helpers import raw_frame

from ledgerline.operators import conform
from ledgerline.params import Params

P = Params(lag_days=60)


def _by_id(df):
    return {r["complaint_id"]: r for r in df.collect()}


def test_required_fields_drop_blank_id_and_issue(spark):
    raw = raw_frame(spark, [{"complaint_id": "1"}, {"complaint_id": ""}, {"complaint_id": "3", "issue": "  "}])
    out = conform.stage(raw, P)
    assert sorted(r.complaint_id for r in out.collect()) == ["1"]


def test_blank_response_kept_as_partial_with_lag_flag_resolved(spark):
    raw = raw_frame(spark, [{"complaint_id": "1", "company_response_to_consumer": ""}],
                    snapshot=dt.date(2025, 6, 1))
    r = conform.status_context(raw, P).collect()[0]
    assert r.company_response is None
    assert r.data_completeness_status == "PARTIAL"
    assert r.recent_publication_lag_flag is False


def test_none_literal_only_on_public_response_and_tags(spark):
    raw = raw_frame(spark, [{"complaint_id": "1", "company_public_response": "None", "tags": " None ",
                             "product": "None"}])
    r = conform.stage(raw, P).collect()[0]
    assert r.company_public_response is None and r.tags is None
    assert r.product == "None"


def test_timely_normalisation(spark):
    raw = raw_frame(spark, [{"complaint_id": "1", "timely_response": " yes"},
                            {"complaint_id": "2", "timely_response": "NO"},
                            {"complaint_id": "3", "timely_response": ""}])
    got = {k: v.timely_response_status for k, v in _by_id(conform.stage(raw, P)).items()}
    assert got == {"1": "YES", "2": "NO", "3": "UNKNOWN"}


def test_lag_flag_boundary_and_in_progress(spark):
    snap = dt.date(2024, 12, 31)
    edge = (snap - dt.timedelta(days=60)).isoformat()
    before = (snap - dt.timedelta(days=61)).isoformat()
    raw = raw_frame(spark, [
        {"complaint_id": "edge", "date_received": edge},
        {"complaint_id": "old", "date_received": before},
        {"complaint_id": "prog", "date_received": "2023-12-01", "company_response_to_consumer": "In progress"},
    ], snapshot=snap)
    got = {k: v.recent_publication_lag_flag for k, v in _by_id(conform.stage(raw, P)).items()}
    assert got == {"edge": True, "old": False, "prog": True}


def test_unparsable_date_becomes_null_and_is_dropped(spark):
    raw = raw_frame(spark, [{"complaint_id": "1", "date_received": "not a date"},
                            {"complaint_id": "2"}])
    assert [r.complaint_id for r in conform.stage(raw, P).collect()] == ["2"]


def test_narrative_presence_only(spark):
    raw = raw_frame(spark, [{"complaint_id": "1", "consumer_complaint_narrative": "text"},
                            {"complaint_id": "2", "consumer_complaint_narrative": "  "}])
    out = conform.stage(raw, P)
    assert "consumer_complaint_narrative" not in out.columns
    assert {k: v.has_narrative for k, v in _by_id(out).items()} == {"1": True, "2": False}


def test_forbidden_columns():
    cols = ["has_narrative", "consumer_complaint_narrative", "zip_code", "Tags", "product"]
    assert conform.forbidden_columns(cols) == ["consumer_complaint_narrative", "zip_code", "Tags"]
