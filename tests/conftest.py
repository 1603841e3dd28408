from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from eventloom import build_session  # noqa: E402
from eventloom.plans import staging  # noqa: E402
from eventloom.sources import readers, schemas  # noqa: E402
from eventloom.sources.lake import Lake  # noqa: E402

SF = "/root/testdata/sf0.001"
AS_OF = "2025-01-16 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "eventloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def ts(text: str | None):
    import datetime as dt

    return dt.datetime.fromisoformat(text) if text else None


def make_events(spark, rows: list[dict]):
    """Raw events from partial rows; unnamed columns are NULL."""
    names = schemas.EVENTS.fieldNames()
    loose = type(schemas.EVENTS)([type(f)(f.name, f.dataType, True) for f in schemas.EVENTS])
    values = [tuple(r.get(n) if not n.endswith("_at") and n != "event_timestamp" else ts(r.get(n)) for n in names) for r in rows]
    return readers.with_date(readers.inline(spark, values, loose), "event_timestamp", "event_date")


def make_users(spark, rows: list[dict]):
    names = schemas.USERS.fieldNames()
    loose = type(schemas.USERS)([type(f)(f.name, f.dataType, True) for f in schemas.USERS])
    values = [tuple(r.get(n) if not n.endswith("_at") else ts(r.get(n)) for n in names) for r in rows]
    return readers.with_date(readers.inline(spark, values, loose), "created_at", "user_date")


def _event(i, user, kind, at, session, device, platform, version, payload):
    return dict(
        event_id=f"evt_{i:03d}", user_id=user, event_type=kind, event_timestamp=at, session_id=session,
        device_type=device, platform=platform, app_version=version, metadata=payload,
    )


# The sample rows.
SAMPLE_EVENTS = [
    _event(1, "user_001", "purchase", "2025-01-15 10:30:00", "sess_001", "mobile", "ios", "1.2.3",
           '{"amount": 42.50, "currency": "USD", "product_id": "prod_123"}'),
    _event(2, "user_001", "page_view", "2025-01-15 10:25:00", "sess_001", "mobile", "ios", "1.2.3",
           '{"page": "/products", "category": "electronics"}'),
    _event(3, "user_002", "signup", "2025-01-15 09:15:00", "sess_002", "desktop", "web", "2.1.0",
           '{"source": "google_ads", "campaign": "summer_sale"}'),
    _event(4, "user_001", "purchase", "2025-01-14 16:45:00", "sess_003", "mobile", "android", "1.2.3",
           '{"amount": 25.99, "currency": "USD", "product_id": "prod_456"}'),
    _event(5, "user_003", "page_view", "2025-01-15 11:20:00", "sess_004", "desktop", "web", "2.1.0",
           '{"page": "/checkout", "category": "clothing"}'),
]
SAMPLE_USERS = [
    dict(user_id="user_001", email="john@example.com", created_at="2025-01-01 08:00:00", first_name="John",
         last_name="Doe", country="US", timezone="America/New_York", subscription_tier="premium",
         metadata='{"source": "organic", "referral_code": "FRIEND123"}'),
    dict(user_id="user_002", email="jane@example.com", created_at="2025-01-10 14:30:00", first_name="Jane",
         last_name="Smith", country="CA", timezone="America/Toronto", subscription_tier="basic",
         metadata='{"source": "google_ads", "campaign": "winter_promo"}'),
    dict(user_id="user_003", email="bob@example.com", created_at="2025-01-12 09:15:00", first_name="Bob",
         last_name="Johnson", country="UK", timezone="Europe/London", subscription_tier="premium",
         metadata='{"source": "social_media", "platform": "facebook"}'),
]


@pytest.fixture
def sample(spark):
    events = staging.stg_events(make_events(spark, SAMPLE_EVENTS), AS_OF)
    users = staging.stg_users(make_users(spark, SAMPLE_USERS), AS_OF)
    return events, users


def rows_of(df, *columns):
    columns = columns or tuple(c for c in df.columns if c not in ("processed_at", "last_updated"))
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
