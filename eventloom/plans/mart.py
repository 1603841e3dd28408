"""Curated -> mart: user analytics, daily business KPIs and training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.expressions import (
    AsOf,
    as_of_date,
    as_of_ts,
    growth,
    month_of,
    pct,
    ratio,
    ratio_or,
    sunday_of,
)
from eventloom.functions.measures import rows
from eventloom.operators.sessions import sessions_from_events
from eventloom.operators.windows import ROWS, following, lifetime, previous, trailing
from eventloom.plans.curated import engagement_scores, recent_totals, value_tier


def _platform_preference() -> Column:
    web, mobile = F.col("web_events"), F.col("mobile_events")
    return (
        F.when(web > mobile, "web")
        .when(mobile > web, "mobile")
        .when(web > 0, "balanced")  # equal here, unless a count is NULL
        .otherwise("unknown")
    )


def _behavior() -> Column:
    return (
        F.when(F.col("page_views") > F.col("total_events") * F.lit(0.7), "browser")
        .when(F.col("total_purchases") > 0, "buyer")
        .when(F.col("signups") > 0, "new_user")
        .otherwise("explorer")
    )


def user_analytics(metrics: DataFrame, as_of: AsOf, mode: str = ROWS) -> DataFrame:
    week, month, ever = F.col("events_last_7_days"), F.col("events_last_30_days"), F.col("lifetime_events")
    trend = (
        F.when(week > month * F.lit(0.4), "increasing")
        .when(week < month * F.lit(0.1), "decreasing")
        .otherwise("stable")
    )
    # With row windows the first two cannot occur: every row is an active day.  They can in
    # calendar mode only if zero-activity days are added to the input.
    churn = (
        F.when((week == 0) & (month > 0), "at_risk")
        .when((month == 0) & (ever > 0), "churned")
        .when(week > 0, "active")
        .otherwise("inactive")
    )
    derived = {
        "is_active_this_week": week > 0,
        "is_active_this_month": month > 0,
        "avg_lifetime_purchase_amount": ratio_or(
            F.col("lifetime_revenue"), F.col("lifetime_purchases"), 2, 0.0
        ),
        "engagement_trend": trend,
        "preferred_platform": _platform_preference(),
        "user_behavior_type": _behavior(),
        "value_segment": value_tier("lifetime_revenue"),
        "churn_risk_status": churn,
    } | engagement_scores()
    return metrics.withColumns(recent_totals(mode, metrics.columns)).withColumns(derived).select(
        "user_id", "date", "country", "user_tier", "days_since_registration",
        "is_active_today", "is_active_this_week", "is_active_this_month",
        "total_events", "unique_event_types",
        "events_last_7_days", "events_last_30_days", "lifetime_events",
        "total_purchases", "total_revenue", "avg_purchase_amount",
        "purchases_last_7_days", "purchases_last_30_days",
        "lifetime_purchases", "lifetime_revenue", "avg_lifetime_purchase_amount",
        "total_sessions", "avg_events_per_session", "sessions_last_7_days", "sessions_last_30_days",
        "engagement_score_7d", "engagement_score_30d", "engagement_trend",
        "preferred_platform", "user_behavior_type", "value_segment", "churn_risk_status",
        "web_events", "mobile_events", "page_views", "signups", "logins",
        "unique_products_viewed", "unique_categories_viewed",
        as_of_ts(as_of).alias("last_updated"),
    )


# The reported countries and tiers.
COUNTRIES = {"us": "US", "ca": "CA", "uk": "UK"}
REPORTED_TIERS = ("premium", "basic")


def _user_days(metrics: DataFrame) -> DataFrame:
    """One row per user and date with the facts the KPIs count.

    Everything below needs the user layout only, so one exchange serves both the grouping and the
    window; it disappears when the input is already laid out by user.  Marking a user's first day
    of each week and month turns the distinct weekly and monthly users into plain sums.
    """
    age, country, tier = F.col("days_since_registration"), F.col("country"), F.col("user_tier")
    spent, bought = F.col("total_revenue"), F.col("total_purchases")
    grouped = (
        metrics.repartition("user_id")
        .groupBy("user_id", "date")
        .agg(
            rows().alias("n"),
            F.sum("total_events").alias("events"),
            F.sum(bought).alias("purchases"),
            F.sum(spent).alias("revenue"),
            F.sum(F.when(bought > 0, spent / bought)).alias("ticket"),
            F.count_if(bought > 0).alias("tickets"),
            F.bool_or(age == 0).alias("new"),
            F.bool_or(age.between(1, 7)).alias("new_week"),
            F.bool_or(age.between(1, 30)).alias("new_month"),
            *[F.bool_or(country == v).alias(k) for k, v in COUNTRIES.items()],
            # NOT IN stays NULL for an unknown country, which then counts nowhere.
            F.bool_or(~country.isin(*COUNTRIES.values())).alias("other"),
            *[F.bool_or(tier == t).alias(t) for t in REPORTED_TIERS],
            *[F.sum(F.when(tier == t, spent).otherwise(F.lit(0.0))).alias(f"revenue_{t}") for t in REPORTED_TIERS],
        )
    )
    last_seen = previous("date", "user_id", "date")
    starts = {
        "starts_week": sunday_of(F.col("date")) != sunday_of(F.col("_seen")),
        "starts_month": month_of(F.col("date")) != month_of(F.col("_seen")),
    }
    return grouped.withColumn("_seen", last_seen).withColumns(
        {k: F.coalesce(c, F.lit(True)) for k, c in starts.items()}
    )


def business_metrics(metrics: DataFrame, as_of: AsOf) -> DataFrame:
    flags = {
        "new_users": "new",
        "new_users_this_week": "new_week",
        "new_users_this_month": "new_month",
        **{f"users_{k}": k for k in (*COUNTRIES, "other")},
        **{f"{t}_users": t for t in REPORTED_TIERS},
    }
    daily = _user_days(metrics).groupBy("date").agg(
        rows().alias("daily_active_users"),
        *[F.count_if(F.col(c)).alias(out) for out, c in flags.items()],
        F.sum("revenue").alias("daily_revenue"),
        F.sum("purchases").alias("daily_purchases"),
        ratio(F.sum("ticket"), F.sum("tickets")).alias("avg_purchase_amount"),
        F.sum("events").alias("total_events"),
        ratio(F.sum("events"), F.sum("n")).alias("avg_events_per_user"),
        *[F.sum(f"revenue_{t}").alias(f"revenue_{t}") for t in REPORTED_TIERS],
        F.count_if("starts_week").alias("_week"),
        F.count_if("starts_month").alias("_month"),
    )
    # From here on there is one row per day, so a single task is enough for the global windows.
    dau, earned = F.col("daily_active_users"), F.col("daily_revenue")
    compared = {"dau": "daily_active_users", "revenue": "daily_revenue", "purchases": "daily_purchases"}
    over_days = {
        "weekly_active_users": F.sum("_week").over(Window.partitionBy(sunday_of(F.col("date")))),
        "monthly_active_users": F.sum("_month").over(Window.partitionBy(month_of(F.col("date")))),
        "weekly_avg_revenue": F.avg("daily_revenue").over(trailing(None, "date", 7)),
        "monthly_avg_revenue": F.avg("daily_revenue").over(trailing(None, "date", 30)),
        **{f"prev_day_{k}": previous(c, None, "date") for k, c in compared.items()},
    }
    ratios = {
        "avg_events_per_active_user": F.col("avg_events_per_user"),  # every listed user is active
        **{f"pct_users_{k}": pct(F.col(f"users_{k}"), dau) for k in COUNTRIES},
        **{f"pct_{t}_users": pct(F.col(f"{t}_users"), dau) for t in REPORTED_TIERS},
        **{f"pct_revenue_{t}": pct(F.col(f"revenue_{t}"), earned) for t in REPORTED_TIERS},
        "purchase_conversion_rate": pct(F.col("daily_purchases"), dau),
        "new_user_rate": pct(F.col("new_users"), dau),
        "revenue_per_user": ratio(earned, dau, 2),
        **{f"revenue_per_{t}_user": ratio(F.col(f"revenue_{t}"), F.col(f"{t}_users"), 2) for t in REPORTED_TIERS},
    }
    rates = {f"{k}_growth_rate": growth(F.col(compared[k]), F.col(f"prev_day_{k}")) for k in ("dau", "revenue")}
    return daily.withColumns(over_days).withColumns(ratios | rates).select(
        "date",
        "daily_active_users", "new_users", "new_users_this_week", "new_users_this_month",
        "weekly_active_users", "monthly_active_users",
        "daily_revenue", "daily_purchases", "avg_purchase_amount",
        "weekly_avg_revenue", "monthly_avg_revenue",
        "total_events", "avg_events_per_user", "avg_events_per_active_user",
        "users_us", "users_ca", "users_uk", "users_other",
        "pct_users_us", "pct_users_ca", "pct_users_uk",
        "premium_users", "basic_users", "pct_premium_users", "pct_basic_users",
        "revenue_premium", "revenue_basic", "pct_revenue_premium", "pct_revenue_basic",
        "purchase_conversion_rate", "new_user_rate",
        "revenue_per_user", "revenue_per_premium_user", "revenue_per_basic_user",
        *[f"prev_day_{k}" for k in compared], *rates,
        as_of_ts(as_of).alias("last_updated"),
    )


def ml_training(metrics: DataFrame, features: DataFrame, events: DataFrame, as_of: AsOf) -> DataFrame:
    """Feature groups plus forward-looking labels.

    A label whose horizon reaches past the last day of data is unknown, hence NULL.
    """
    last_day = metrics.agg(F.max("date")).scalar()
    ever = lifetime("user_id", "date")
    lengths = (
        sessions_from_events(events.where("is_valid AND session_id IS NOT NULL"))
        .groupBy("user_id", F.col("session_date").alias("date"))
        .agg(F.sum("duration_seconds").alias("_seconds"), rows().alias("_sessions"))
    )

    def known(days: int, c: Column) -> Column:
        return F.when(F.date_add("date", days) <= F.col("_last_day"), c)

    labelled = (
        metrics.select("user_id", "date", "total_purchases")
        .join(lengths, ["user_id", "date"], "left")
        .withColumn("_last_day", last_day)
        .select(
            "user_id",
            F.col("date").alias("feature_date"),
            known(7, F.coalesce(F.sum("total_purchases").over(following("user_id", "date", 7)), F.lit(0)) > 0)
            .alias("will_purchase_next_7_days"),
            known(30, F.count("date").over(following("user_id", "date", 30)) == 0)
            .alias("will_churn_next_30_days"),
            F.datediff(
                as_of_date(as_of), F.max(F.when(F.col("total_purchases") > 0, F.col("date"))).over(ever)
            ).alias("_since_purchase"),
            ratio(F.sum("_seconds").over(ever), F.sum("_sessions").over(ever)).alias("_session_seconds"),
        )
    )

    def group(**fields: str) -> Column:
        return F.struct(*[F.col(src).alias(out) for out, src in fields.items()])

    return features.join(labelled, ["user_id", "feature_date"]).select(
        "user_id", "feature_date", "will_purchase_next_7_days", "will_churn_next_30_days",
        group(
            days_since_last_event="days_since_last_event",
            days_since_last_purchase="_since_purchase",
            days_since_registration="days_since_registration",
        ).alias("recency_features"),
        group(
            events_7d="events_last_7_days", events_30d="events_last_30_days",
            purchases_7d="purchases_last_7_days", purchases_30d="purchases_last_30_days",
        ).alias("frequency_features"),
        group(
            revenue_7d="revenue_last_7_days", revenue_30d="revenue_last_30_days",
            lifetime_revenue="lifetime_revenue", avg_purchase_amount="avg_purchase_amount_30d",
        ).alias("monetary_features"),
        group(
            sessions_7d="sessions_last_7_days", sessions_30d="sessions_last_30_days",
            avg_session_duration="_session_seconds", platform_diversity="platform_diversity_score",
        ).alias("engagement_features"),
        as_of_ts(as_of).alias("last_updated"),
    )
