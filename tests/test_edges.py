"""Edge rows written by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.functions.expressions import growth, hours_between, ratio, rounded, sunday_of
from eventloom.operators.sessions import sessions_from_events
from eventloom.operators.windows import CALENDAR
from eventloom.plans import curated, mart, staging, views
from tests.conftest import AS_OF, make_events, make_users, rows_of


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "payload, amount",
    [
        ('{"amount": 5, bad', None), ("{}", None), ('{"amount": null}', None), ('{"amount": "abc"}', None),
        ('{"amount": {"x":1}}', None), ('{"amount": [1]}', None), (None, None), ('[{"amount": 1}]', None),
        ('{"amount": "7.5"}', 7.5), ('{"amount": 42.50}', 42.5), ('{"amount": -3}', -3.0),
    ],
)
def test_amount(spark, payload, amount):
    row = dict(event_id="e", user_id="u", event_type="purchase", event_timestamp="2025-01-15 00:00:00", metadata=payload)
    got = staging.stg_events(make_events(spark, [row]), AS_OF).first()
    assert got.amount == amount and got.is_valid


def test_text_that_looks_like_a_container(spark):
    row = dict(event_id="e", user_id="u", event_type="x", event_timestamp="2025-01-15 00:00:00",
               metadata='{"page": "[home]", "category": ["a"], "source": "{", "campaign": true}')
    got = staging.stg_events(make_events(spark, [row]), AS_OF).first()
    assert (got.page, got.category, got.source, got.campaign) == ("[home]", None, "{", "true")


def test_invalid_event_lists_errors_in_order(spark):
    got = staging.stg_events(make_events(spark, [dict(event_id="", user_id="", event_type="")]), AS_OF).first()
    assert not got.is_valid
    assert got.validation_errors == [
        "missing_event_id", "missing_user_id", "missing_event_type", "missing_event_timestamp",
    ]
    assert (got.event_id_length, got.user_id_length, got.event_type_length) == (0, 0, 0)


@pytest.mark.parametrize(
    "email, errors",
    [
        ("", ["missing_email", "invalid_email_format"]), (None, ["missing_email"]),
        ("a@b", ["invalid_email_format"]), ("a.b+c@d-e.org", []),
    ],
)
def test_email(spark, email, errors):
    user = dict(user_id="u", email=email, created_at="2025-01-01 00:00:00")
    got = staging.stg_users(make_users(spark, [user]), AS_OF).first()
    assert (got.validation_errors, got.is_valid) == (errors, not errors)


@pytest.mark.parametrize(
    "first, last, full", [("A", "B", "A B"), ("A", None, "A"), (None, "B", "B"), (None, None, ""), ("", "B", " B")]
)
def test_full_name(spark, first, last, full):
    user = dict(user_id="u", email="a@b.cd", created_at="2025-01-01 00:00:00", first_name=first, last_name=last)
    assert staging.stg_users(make_users(spark, [user]), AS_OF).first().full_name == full


def test_user_dates_and_defaults(spark):
    user = dict(user_id="u", email="a@b.cd", created_at="2025-01-01 23:59:59", updated_at="2025-01-15 00:00:01", country=" us ")
    got = staging.stg_users(make_users(spark, [user]), AS_OF).first()
    assert (got.days_since_registration, got.days_since_last_update) == (15, 1)
    assert (got.country_standardized, got.subscription_tier_standardized) == ("US", "basic")


def test_rows_and_calendar_windows_differ(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=5 * i) for i in range(9)]
    metrics = spark.createDataFrame([("u", d) for d in days], "user_id string, date date").withColumns(
        {c: F.lit(1) for c in ("total_events", "total_purchases", "total_sessions")} | {"total_revenue": F.lit(1.0)}
    )
    by_rows = metrics.withColumns(curated.recent_totals()).orderBy("date").collect()[-1]
    by_days = metrics.withColumns(curated.recent_totals(CALENDAR)).orderBy("date").collect()[-1]
    assert (by_rows.events_last_7_days, by_rows.events_last_30_days) == (7, 9)
    assert (by_days.events_last_7_days, by_days.events_last_30_days) == (2, 6)


def test_third_place_tie_goes_by_name(spark):
    kinds = ["click"] * 3 + ["login"] * 2 + ["view", "error"]
    rows = [dict(event_id=str(i), user_id="u", event_type=k, event_timestamp="2025-01-15 00:00:00") for i, k in enumerate(kinds)]
    events = staging.stg_events(make_events(spark, rows), AS_OF)
    top = views.user_event_preferences(events).first().top_3_event_types
    assert [e.event_type for e in top] == ["click", "login", "error"]


def test_weeks_start_on_sunday(spark):
    def week(d):
        return value(spark, sunday_of(F.lit(d).cast("date")))

    assert week("2024-01-06") == dt.date(2023, 12, 31)
    assert week("2024-01-07") == dt.date(2024, 1, 7)
    assert week("2024-01-13") == dt.date(2024, 1, 7)


def test_cohort_return_months(spark):
    rows = [
        dict(event_id=str(i), user_id="u", event_type="click", event_timestamp=at)
        for i, at in enumerate(["2024-01-15 00:00:00", "2024-01-20 00:00:00", "2024-03-02 00:00:00"])
    ]
    got = views.user_cohorts(staging.stg_events(make_events(spark, rows), AS_OF))
    assert rows_of(got) == [(dt.date(2024, 1, 1), 1, 1, 0, 1, 0)]


def test_country_buckets(spark):
    rows = [dict(event_id=str(i), user_id=f"u{i}", event_type="click", event_timestamp="2025-01-15 00:00:00", session_id="s")
            for i in range(3)]
    people = [dict(user_id="u1", email="a@b.cd", created_at="2025-01-01 00:00:00", country=""),
              dict(user_id="u2", email="a@b.cd", created_at="2025-01-01 00:00:00", country="DE", subscription_tier="enterprise")]
    metrics = curated.user_metrics(
        staging.stg_events(make_events(spark, rows), AS_OF), staging.stg_users(make_users(spark, people), AS_OF), AS_OF
    )
    got = mart.business_metrics(metrics, AS_OF).first()
    assert (got.daily_active_users, got.users_us, got.users_other) == (3, 0, 2)  # u0 has no country
    assert (got.premium_users, got.basic_users) == (0, 1)
    assert got.pct_revenue_basic is None  # no revenue


def test_repeated_user_days_count_once(spark):
    """Repeated users rows double the metrics; distinct users must not double."""
    metrics = spark.createDataFrame(
        [("u", dt.date(2024, 1, d), c, "basic", 3, 2, 1, 5.0) for d in (1, 2) for c in ("US", "CA")],
        "user_id string, date date, country string, user_tier string, days_since_registration int,"
        "total_events long, total_purchases long, total_revenue double",
    )
    got = mart.business_metrics(metrics, AS_OF).orderBy("date").collect()
    assert [(r.daily_active_users, r.users_us, r.users_ca, r.daily_revenue, r.avg_events_per_user) for r in got] == [
        (1, 1, 1, 10.0, 2.0)] * 2
    assert [r.monthly_active_users for r in got] == [1, 1]


def test_events_without_sessions_do_not_divide_by_zero(spark):
    row = dict(event_id="e", user_id="u", event_type="click", event_timestamp="2025-01-15 00:00:00")
    events = staging.stg_events(make_events(spark, [row]), AS_OF)
    users = staging.stg_users(make_users(spark, []), AS_OF)
    got = curated.user_metrics(events, users, AS_OF).first()
    assert (got.avg_events_per_session, got.events_per_session, got.total_sessions) == (None, 0.0, 0)


def test_empty_day_gives_null_ratio(spark):
    events = staging.stg_events(make_events(spark, []), AS_OF)
    users = staging.stg_users(make_users(spark, []), AS_OF)
    assert rows_of(views.dag_quality_check(events, users, AS_OF)) == [("events", 0, 0, None), ("users", 0, 0, None)]
    assert mart.business_metrics(curated.user_metrics(events, users, AS_OF), AS_OF).count() == 0


def test_session_bounds_ignore_arrival_order(spark):
    rows = [
        dict(event_id=i, user_id="u", event_type=k, event_timestamp=f"2025-01-15 {at}", session_id="s", device_type=d)
        for i, k, at, d in (("2", "page_view", "10:05:00", "tablet"), ("3", "click", "10:09:30", "other"), ("1", "click", "10:00:00", "mobile"))
    ]
    got = sessions_from_events(make_events(spark, rows)).first()
    assert (str(got.started_at), str(got.ended_at)) == ("2025-01-15 10:00:00", "2025-01-15 10:09:30")
    assert (got.duration_seconds, got.page_views, got.events_count, got.device_type) == (570, 1, 3, "mobile")


def test_stg_sessions_flags(spark):
    t = dt.datetime(2025, 1, 15)
    rows = [("s1", "u", t, t + dt.timedelta(seconds=90), None), ("", None, None, None, None),
            ("s2", "u", t, t - dt.timedelta(seconds=5), 7)]
    raw = spark.createDataFrame(rows, "session_id string, user_id string, started_at timestamp, ended_at timestamp, duration_seconds long")
    got = {r.session_id: r for r in staging.stg_sessions(raw, AS_OF).collect()}
    assert got["s1"].is_valid and got["s1"].duration_seconds == 90
    assert got[""].validation_errors == ["missing_session_id", "missing_user_id", "missing_started_at"]
    assert got["s2"].validation_errors == ["negative_duration"] and got["s2"].duration_seconds == 7


def test_small_expressions(spark):
    at = [F.lit(f"2024-01-01 {h}").cast("timestamp") for h in ("00:00:00", "01:59:59")]
    assert value(spark, hours_between(at[1], at[0])) == 1
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, growth(F.lit(3), F.lit(0))) is None
    noisy = F.lit(160.95000000000002) / 2, F.lit(160.94999999999996) / 2
    assert {value(spark, rounded(c, 2)) for c in noisy} == {80.48}
    score = curated.engagement_score("x", 1, 1, 1)
    row = spark.createDataFrame([(None, 1, 1)], "events_x int, purchases_x int, sessions_x int")
    assert row.select(score.alias("s")).first().s is None


def test_rounding_once(spark):
    values = [0.0049999999996, -0.0049999999996, 0.005, 80.475, 80.47499999999999, -80.47499999999999, 1e12 + 0.004, float("inf"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.v for r in df.select("i", rounded(F.col("v"), 2).alias("v")).orderBy("i").collect()]
    assert got == [0.0, 0.0, 0.01, 80.48, 80.48, -80.48, 1e12, float("inf"), None]
