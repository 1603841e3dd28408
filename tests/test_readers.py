"""Text sources with explicit schemas."""

import datetime as dt

from eventloom.sources import readers
from tests.conftest import SAMPLE_EVENTS, SAMPLE_USERS, make_events, make_users, rows_of


def test_json_array_file(spark, tmp_path):
    (tmp_path / "users.json").write_text(
        '[{"user_id": "u1", "email": "a@b.cd", "created_at": "2025-01-01T08:00:00Z", "metadata": "{\\"source\\": \\"x\\"}"},\n'
        ' {"user_id": "u2", "email": null, "created_at": "2025-01-02T08:00:00.123456Z", "unknown": 1}]'
    )
    got = readers.read_users(spark, str(tmp_path / "users.json"), "json").orderBy("user_id").collect()
    assert [(r.user_id, r.email, r.metadata, r.user_date) for r in got] == [
        ("u1", "a@b.cd", '{"source": "x"}', dt.date(2025, 1, 1)), ("u2", None, None, dt.date(2025, 1, 2)),
    ]
    assert got[1].created_at.microsecond == 123456 and got[0].updated_at is None


def test_csv_keeps_quotes_commas_and_newlines(spark, tmp_path):
    rows = SAMPLE_EVENTS + [dict(SAMPLE_EVENTS[0], event_id="evt_x", metadata='{"page": "a,\\"b\\"\n c"}')]
    events = make_events(spark, rows)
    readers.write_csv(events.drop("event_date"), str(tmp_path / "csv"))
    assert rows_of(readers.read_events(spark, str(tmp_path / "csv"), "csv", multi_line=True)) == rows_of(events)


def test_csv_tells_empty_from_null(spark, tmp_path):
    rows = [dict(SAMPLE_EVENTS[0], event_id=i, user_id=u, metadata=m) for i, u, m in (("a", "", None), ("b", None, ""), ("c", "\\", '""'))]
    events = make_events(spark, rows)
    readers.write_csv(events.drop("event_date"), str(tmp_path / "csv"))
    assert rows_of(readers.read_events(spark, str(tmp_path / "csv"), "csv")) == rows_of(events)


def test_json_lines_round_trip(spark, tmp_path):
    users = make_users(spark, SAMPLE_USERS)
    readers.write_json_lines(users.drop("user_date"), str(tmp_path / "jsonl"))
    assert rows_of(readers.read_users(spark, str(tmp_path / "jsonl"), "jsonl")) == rows_of(users)
