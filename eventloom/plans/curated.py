"""Staging -> curated: daily metrics per user and per event type, and features per user day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import measures as m
from eventloom.functions.expressions import AsOf, as_of_date, as_of_ts, clamp, growth, ratio, ratio_or
from eventloom.operators.windows import ROWS, lifetime, previous, sums, trailing

BIG, SMALL = 1000, 100  # revenue thresholds of the value tiers


def valid_daily(events: DataFrame) -> DataFrame:
    # A valid event has a timestamp, hence a date: the keys below are never NULL.
    return events.where("is_valid").withColumnRenamed("event_date", "date")


def per_day(events: DataFrame, key: str, plain: dict[str, Column], distincts: dict[str, str]) -> DataFrame:
    """Daily aggregates of one key, exact distinct counts beside the plain ones.

    The two kinds are aggregated apart and joined on the layout both end with, so the join adds no
    exchange.  In one aggregate the distinct counts are expanded to a row per value, and every
    such row would drag the buffers of all plain aggregates through both shuffles.  The expanded
    rows are spread by their values and combined on the map side, so neither a user with a huge day
    nor a huge event type ends up in one task; a collect_set would gather it in one buffer.
    """
    daily = valid_daily(events)
    keys = [key, "date"]
    measured = daily.groupBy(*keys).agg(*[c.alias(n) for n, c in plain.items()])
    counted = daily.groupBy(*keys).agg(*[m.distinct(c).alias(n) for n, c in distincts.items()])
    return measured.join(counted, keys)


def daily_user_activity(events: DataFrame) -> DataFrame:
    """The user-day aggregate behind ``user_metrics``."""
    wide = per_day(
        events,
        "user_id",
        {
            "total_events": m.rows(),
            "total_purchases": F.count_if(m.is_type("purchase")),
            "total_revenue": m.revenue(),
            "avg_purchase_amount": F.avg(m.purchase_amount()),
            "web_events": m.hits("platform", "web"),
            "mobile_events": m.hits("platform", "mobile"),
            "desktop_events": m.hits("device_type", "desktop"),
            "mobile_device_events": m.hits("device_type", "mobile"),
            "page_views": m.hits("event_type", "page_view"),
            "signups": m.hits("event_type", "signup"),
            "logins": m.hits("event_type", "login"),
            "revenue_usd": m.revenue("USD"),
            "revenue_eur": m.revenue("EUR"),
            "purchases_without_amount": m.missing("amount", "purchase"),
            "purchases_without_product": m.missing("product_id", "purchase"),
        },
        {
            "unique_event_types": "event_type",
            "unique_sessions": "session_id",
            "unique_products_viewed": "product_id",
            "unique_categories_viewed": "category",
        },
    )
    return wide.withColumns(
        {
            "total_sessions": F.col("unique_sessions"),
            "avg_events_per_session": ratio(F.col("total_events"), F.col("unique_sessions"), 2),
        }
    ).select(
        "user_id", "date",
        "total_events", "unique_event_types", "unique_sessions",
        "total_purchases", "total_revenue", "avg_purchase_amount",
        "web_events", "mobile_events", "desktop_events", "mobile_device_events",
        "page_views", "signups", "logins",
        "unique_products_viewed", "unique_categories_viewed",
        "total_sessions", "avg_events_per_session",
        "revenue_usd", "revenue_eur", "purchases_without_amount", "purchases_without_product",
    )


def user_context(users: DataFrame) -> DataFrame:
    return users.where("is_valid").select(
        "user_id",
        F.col("country_standardized").alias("country"),
        F.col("subscription_tier_standardized").alias("user_tier"),
        "days_since_registration",
    )


def user_metrics(events: DataFrame, users: DataFrame, as_of: AsOf) -> DataFrame:
    # Joining after the aggregation keeps the join at user-day grain; no hint, so the users side
    # is broadcast only when its size is known to be small.
    daily = daily_user_activity(events)
    joined = daily.join(user_context(users), "user_id", "left")
    n, purchases = F.col("total_events"), F.col("total_purchases")
    return joined.select(
        "user_id", "date", "country", "user_tier", "days_since_registration",
        *daily.columns[2:],
        ratio_or(F.col("total_revenue"), n, 4, 0.0).alias("revenue_per_event"),
        ratio_or(n, F.col("total_sessions"), 2, 0.0).alias("events_per_session"),
        (n > 0).alias("is_active_today"),
        (purchases > 0).alias("made_purchase_today"),
        as_of_ts(as_of).alias("last_updated"),
    )


# Event type groups.
CATEGORIES = {
    "revenue": ("purchase",),
    "engagement": ("page_view", "click", "scroll"),
    "authentication": ("signup", "login", "logout"),
    "discovery": ("search", "filter", "sort"),
    "technical": ("error", "exception", "crash"),
}


def _event_category() -> Column:
    found = F.lit("other")
    for name, types in reversed(CATEGORIES.items()):
        found = F.when(m.is_type(*types), name).otherwise(found)
    return found


def daily_event_type_activity(events: DataFrame) -> DataFrame:
    """Event-type days: few, huge groups."""
    wide = per_day(
        events,
        "event_type",
        {
            "total_events": m.rows(),
            "total_revenue": m.revenue(),
            "avg_revenue_per_event": F.avg(m.purchase_amount()),
            "min_revenue_per_event": F.min(m.purchase_amount()),
            "max_revenue_per_event": F.max(m.purchase_amount()),
            "web_events": m.hits("platform", "web"),
            "mobile_events": m.hits("platform", "mobile"),
            "desktop_events": m.hits("device_type", "desktop"),
            "mobile_device_events": m.hits("device_type", "mobile"),
            "tablet_events": m.hits("device_type", "tablet"),
            **{f"revenue_{c.lower()}": m.revenue(c) for c in ("USD", "EUR", "GBP")},
            "purchases_without_amount": m.missing("amount", "purchase"),
            "purchases_without_product": m.missing("product_id", "purchase"),
            "events_without_category": m.missing("category", "page_view", "purchase"),
        },
        {
            "unique_users": "user_id",
            "unique_sessions": "session_id",
            "unique_products": "product_id",
            "unique_categories": "category",
        },
    )
    n = F.col("total_events")
    return wide.withColumns(
        {
            "avg_events_per_user": ratio(n, F.col("unique_users"), 2),
            "avg_events_per_session": ratio(n, F.col("unique_sessions"), 2),
        }
    ).select(
        "event_type", "date",
        "total_events", "unique_users", "unique_sessions",
        "total_revenue", "avg_revenue_per_event", "min_revenue_per_event", "max_revenue_per_event",
        "web_events", "mobile_events", "desktop_events", "mobile_device_events", "tablet_events",
        "unique_products", "unique_categories",
        "revenue_usd", "revenue_eur", "revenue_gbp",
        "purchases_without_amount", "purchases_without_product", "events_without_category",
        "avg_events_per_user", "avg_events_per_session",
    )


def with_event_growth(daily: DataFrame, as_of: AsOf) -> DataFrame:
    """Categories and growth against the previous row of the same type."""
    earned = F.col("total_revenue")
    value = (
        F.when(m.is_type("purchase") & (earned > 0), "high_value")
        .when(m.is_type("purchase") & (earned == 0), "low_value")
        .when(m.is_type("page_view", "click"), "engagement")
        .otherwise("other")
    )
    compared = {"events": "total_events", "users": "unique_users", "revenue": "total_revenue"}
    before = {f"prev_day_{k}": previous(c, "event_type", "date") for k, c in compared.items()}
    grown = {
        f"{k}_growth_rate": F.when(
            F.col(f"prev_day_{k}") > 0, growth(F.col(c), F.col(f"prev_day_{k}"))
        )
        for k, c in compared.items()
    }
    wide = daily.withColumns(before).withColumns(grown)
    return wide.select(
        "event_type", "date",
        _event_category().alias("event_category"),
        value.alias("value_category"),
        *daily.columns[2:],
        *before, *grown,
        as_of_ts(as_of).alias("last_updated"),
    )


def event_metrics(events: DataFrame, as_of: AsOf) -> DataFrame:
    return with_event_growth(daily_event_type_activity(events), as_of)


def engagement_score(suffix: str, events: int, purchases: int, sessions: int) -> Column:
    weighted = (
        F.col(f"events_{suffix}") * events
        + F.col(f"purchases_{suffix}") * purchases
        + F.col(f"sessions_{suffix}") * sessions
    )
    return clamp(weighted, 0, 100)


def engagement_scores() -> dict[str, Column]:
    return {
        "engagement_score_7d": engagement_score("last_7_days", 2, 10, 3),
        "engagement_score_30d": engagement_score("last_30_days", 1, 5, 2),
    }


def value_tier(money: str) -> Column:
    c = F.col(money)
    return (
        F.when(c >= BIG, "high_value")
        .when(c >= SMALL, "medium_value")
        .when(c > 0, "low_value")
        .otherwise("no_revenue")
    )


def recent_totals(mode: str = ROWS, columns: Sequence[str] = ()) -> dict[str, Column]:
    """7- and 30-step sums of events, purchases, sessions and revenue, and the lifetime sums.

    Rows that follow a carried state have their part of the lifetime sums in columns of its own.
    """
    ever = {n: f"_ever_{n}" if f"_ever_{n}" in columns else f"total_{n}" for n in ("events", "purchases", "revenue")}
    out = {}
    for n in (7, 30):
        out |= sums(
            trailing("user_id", "date", n, mode),
            **{
                f"events_last_{n}_days": "total_events",
                f"purchases_last_{n}_days": "total_purchases",
                f"sessions_last_{n}_days": "total_sessions",
                f"revenue_last_{n}_days": "total_revenue",
            },
        )
    return out | sums(
        lifetime("user_id", "date"),
        **{f"lifetime_{n}": source for n, source in ever.items()},
    )


def lifecycle_stage() -> Column:
    days = F.col("days_since_registration")
    # A user without a registration date counts as mature.
    return F.when(days <= 7, "new").when(days <= 30, "recent").when(days <= 90, "established").otherwise("mature")


def ml_features(metrics: DataFrame, as_of: AsOf, mode: str = ROWS) -> DataFrame:
    w7, w30 = (trailing("user_id", "date", n, mode) for n in (7, 30))
    age = F.datediff(as_of_date(as_of), F.col("date"))
    rolled = metrics.withColumns(
        recent_totals(mode, metrics.columns)
        | {f"avg_revenue_last_{n}_days": F.avg("total_revenue").over(w) for n, w in ((7, w7), (30, w30))}
        | sums(
            w30,
            page_views_last_30_days="page_views",
            signups_last_30_days="signups",
            logins_last_30_days="logins",
            web_events_last_30_days="web_events",
            mobile_events_last_30_days="mobile_events",
        )
        | {
            "max_products_viewed_30d": F.max("unique_products_viewed").over(w30),
            "max_categories_viewed_30d": F.max("unique_categories_viewed").over(w30),
            "activity_consistency_30d": F.stddev_samp("total_events").over(w30),
        }
    )
    web, mobile = F.col("web_events_last_30_days"), F.col("mobile_events_last_30_days")
    derived = {
        "feature_date": F.col("date"),
        "days_since_last_event": age,
        "days_since_last_purchase": age,
        "lifecycle_stage": lifecycle_stage(),
        "value_tier": value_tier("lifetime_revenue"),
        "platform_diversity_score": ratio_or(F.least(web, mobile) * F.lit(2.0), web + mobile, 3, 0.0),
        "avg_days_between_purchases_30d": ratio_or(F.lit(30.0), F.col("purchases_last_30_days"), 1, 999.0),
    } | engagement_scores()
    for n in (7, 30):
        money = F.col(f"revenue_last_{n}_days")
        events, purchases = F.col(f"events_last_{n}_days"), F.col(f"purchases_last_{n}_days")
        derived |= {
            f"revenue_per_event_{n}d": ratio_or(money, events, 4, 0.0),
            f"avg_purchase_amount_{n}d": ratio_or(money, purchases, 2, 0.0),
            f"is_active_{n}d": events > 0,
            f"purchased_{n}d": purchases > 0,
        }
    return rolled.withColumns(derived).select(
        "user_id", "feature_date", "country", "user_tier", "days_since_registration",
        "lifecycle_stage", "value_tier",
        "days_since_last_event", "days_since_last_purchase",
        "events_last_7_days", "events_last_30_days", "purchases_last_7_days", "purchases_last_30_days",
        "sessions_last_7_days", "sessions_last_30_days", "lifetime_events", "lifetime_purchases",
        "revenue_last_7_days", "revenue_last_30_days", "lifetime_revenue",
        "avg_revenue_last_7_days", "avg_revenue_last_30_days",
        "revenue_per_event_7d", "revenue_per_event_30d",
        "avg_purchase_amount_7d", "avg_purchase_amount_30d",
        "engagement_score_7d", "engagement_score_30d",
        "page_views_last_30_days", "signups_last_30_days", "logins_last_30_days",
        "max_products_viewed_30d", "max_categories_viewed_30d",
        "web_events_last_30_days", "mobile_events_last_30_days", "platform_diversity_score",
        "activity_consistency_30d", "avg_days_between_purchases_30d",
        "is_active_7d", "is_active_30d", "purchased_7d", "purchased_30d",
        as_of_ts(as_of).alias("last_updated"),
    )
