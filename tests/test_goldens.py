"""The sample rows against values worked out by hand."""

import datetime as dt

import pytest

from eventloom.plans import curated, mart, views
from tests.conftest import AS_OF, rows_of

D14, D15 = dt.date(2025, 1, 14), dt.date(2025, 1, 15)


def test_user_metrics(sample):
    got = rows_of(
        curated.user_metrics(*sample, AS_OF),
        "user_id", "date", "total_events", "unique_event_types", "unique_sessions", "total_purchases",
        "total_revenue", "web_events", "unique_products_viewed", "unique_categories_viewed", "avg_events_per_session",
    )
    assert got == [
        ("user_001", D14, 1, 1, 1, 1, 25.99, 0, 1, 0, 1.0),
        ("user_001", D15, 2, 2, 1, 1, 42.50, 0, 1, 1, 2.0),
        ("user_002", D15, 1, 1, 1, 0, 0.0, 1, 0, 0, 1.0),
        ("user_003", D15, 1, 1, 1, 0, 0.0, 1, 0, 1, 1.0),
    ]


def test_ml_features(sample):
    features = curated.ml_features(curated.user_metrics(*sample, AS_OF), AS_OF)
    got = rows_of(
        features, "user_id", "feature_date", "events_last_7_days", "purchases_last_7_days", "sessions_last_7_days",
        "revenue_last_7_days", "engagement_score_7d", "engagement_score_30d", "activity_consistency_30d",
    )
    assert [r[:-1] for r in got] == [
        ("user_001", D14, 1, 1, 1, 25.99, 15, 8),
        ("user_001", D15, 3, 2, 2, pytest.approx(68.49), 32, 17),
        ("user_002", D15, 1, 0, 1, 0.0, 5, 3),
        ("user_003", D15, 1, 0, 1, 0.0, 5, 3),
    ]
    assert [r[-1] for r in got] == [None, pytest.approx(0.707107, abs=1e-6), None, None]


def test_business_metrics(sample):
    business = mart.business_metrics(curated.user_metrics(*sample, AS_OF), AS_OF)
    first, second = rows_of(
        business, "date", "daily_active_users", "daily_revenue", "daily_purchases", "purchase_conversion_rate",
        "revenue_per_user", "prev_day_dau", "dau_growth_rate", "revenue_growth_rate",
    )
    assert first == (D14, 1, 25.99, 1, 100.0, 25.99, None, None, None)
    assert second == (D15, 3, 42.5, 1, 33.33, 14.17, 1, 200.0, 63.52)
    last = business.where("date = DATE'2025-01-15'").first()
    assert (last.users_us, last.users_ca, last.users_uk, last.users_other) == (1, 1, 1, 0)
    assert (last.premium_users, last.basic_users) == (2, 1)
    assert (last.weekly_active_users, last.monthly_active_users) == (3, 3)


def test_event_metrics(sample):
    got = rows_of(
        curated.event_metrics(sample[0], AS_OF), "event_type", "date", "prev_day_events", "events_growth_rate",
        "revenue_growth_rate", "event_category", "value_category",
    )
    assert got == [
        ("page_view", D15, None, None, None, "engagement", "engagement"),
        ("purchase", D14, None, None, None, "revenue", "high_value"),
        ("purchase", D15, 1, 0.0, 63.52, "revenue", "high_value"),
        ("signup", D15, None, None, None, "authentication", "other"),
    ]


def test_preferences_keep_rank_order(sample):
    got = {r.user_id: r.top_3_event_types for r in views.user_event_preferences(sample[0]).collect()}
    assert [(e.event_type, e.event_count, e.percentage) for e in got["user_001"]] == [
        ("purchase", 2, 66.67), ("page_view", 1, 33.33),
    ]
