"""Analytics views and reports.  Views are unordered; only final reports sort or limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import measures as m
from eventloom.functions.expressions import AsOf, as_of_date, month_of, pct, ratio, ratio_or
from eventloom.operators.windows import ROWS, sums, trailing
from eventloom.plans.curated import per_day


def register(**views: DataFrame) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def register_all(events: DataFrame, users: DataFrame, as_of: AsOf) -> list[str]:
    """Register every named view over the staged tables; returns the names."""
    found = {
        "recent_events": recent_events(events, as_of),
        "active_users": active_users(events, users, as_of),
        "daily_user_events": daily_user_events(events),
        "user_activity_summary": user_activity_summary(events),
        "user_event_preferences": user_event_preferences(events),
        "daily_active_users": daily_active_users(events),
        "revenue_metrics": revenue_metrics(events),
        "user_cohorts": user_cohorts(events),
        "ml_user_features": ml_user_features(events, as_of),
        "data_quality_summary": data_quality_summary(events, users),
    }
    register(**found)
    return list(found)


def since(column: str, days: int, as_of: AsOf) -> Column:
    return F.col(column) >= F.date_sub(as_of_date(as_of), days)


def on_previous_day(column: str, as_of: AsOf) -> Column:
    return F.col(column) == F.date_sub(as_of_date(as_of), 1)


# --- events and users ------------------------------------------------------------------------


def recent_events(events: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    return events.where(since("event_date", days, as_of) & F.col("is_valid")).select(
        "event_id", "user_id", "event_type", "event_timestamp", "session_id",
        "device_type", "platform", "amount", "currency", "product_id", "category",
    )


def active_users(events: DataFrame, users: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    # Reduce events to one row per user before joining: the join then moves users, not events.
    seen = (
        events.where(since("event_date", days, as_of) & F.col("is_valid"))
        .groupBy("user_id")
        .agg(F.max("event_timestamp").alias("last_activity"))
    )
    shown = ["user_id", "email", "created_at", "country", "subscription_tier"]
    # Users may repeat before the upsert; grouping keeps the rows distinct.
    people = users.where("is_valid").select(*shown).distinct()
    return people.join(seen, "user_id")


def daily_user_events(events: DataFrame) -> DataFrame:
    kinds, platforms = ("purchase", "page_view", "signup"), ("web", "mobile")
    plain = {
        "total_events": m.rows(),
        **{f"{t}_events": m.hits("event_type", t) for t in kinds},
        "total_revenue": m.revenue(),
        **{f"{p}_events": m.hits("platform", p) for p in platforms},
    }
    distincts = {"unique_event_types": "event_type", "unique_sessions": "session_id"}
    return per_day(events, "user_id", plain, distincts).select(
        "user_id", F.col("date").alias("event_date"), "total_events", *distincts,
        *[f"{t}_events" for t in kinds], "total_revenue", *[f"{p}_events" for p in platforms],
    )


def user_daily_lookup(events: DataFrame, user_id: str, as_of: AsOf, days: int = 30) -> DataFrame:
    """One user's days.  Both filters are on grouping keys, so they reach the scan."""
    return (
        daily_user_events(events)
        .where((F.col("user_id") == user_id) & since("event_date", days, as_of))
        .select("user_id", "event_date", "total_events", "unique_event_types", "total_revenue")
        .orderBy(F.desc("event_date"))
    )


def _active_days(events: DataFrame) -> DataFrame:
    return (
        events.where("is_valid")
        .groupBy("user_id")
        .agg(
            F.count_distinct("event_date").alias("active_days"),
            F.min("event_date").alias("first_activity_date"),
            F.max("event_date").alias("last_activity_date"),
        )
    )


def user_activity_summary(events: DataFrame) -> DataFrame:
    days = F.col("active_days")
    span = F.datediff("last_activity_date", "first_activity_date") + 1
    category = (
        F.when(days >= 20, "highly_active")
        .when(days >= 10, "moderately_active")
        .when(days >= 5, "occasionally_active")
        .otherwise("rarely_active")
    )
    return _active_days(events).withColumns(
        {
            "total_days_in_range": span,
            "activity_rate": ratio(days, span, 3),
            "activity_category": category,
        }
    )


def user_active_days_lookup(
    events: DataFrame, user_ids: Sequence[str], date_from: str, date_to: str
) -> DataFrame:
    """Users whose whole history lies inside the range."""
    return (
        user_activity_summary(events)
        .where(F.col("user_id").isin(*user_ids))
        .where(F.col("first_activity_date") >= F.lit(date_from).cast("date"))
        .where(F.col("last_activity_date") <= F.lit(date_to).cast("date"))
        .select("user_id", "active_days", "total_days_in_range", "activity_rate", "activity_category")
        .orderBy(F.desc("active_days"))
    )


def active_days_in_range(events: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Active days of every user inside the range."""
    inside = F.col("event_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    return (
        events.where(F.col("is_valid") & inside)
        .groupBy("user_id")
        .agg(F.count_distinct("event_date").alias("active_days"))
    )


def user_event_preferences(events: DataFrame, k: int = 3) -> DataFrame:
    """Each user's k most frequent event types; the share is of those k.  Ties go by name."""
    counts = events.where("is_valid").groupBy("user_id", "event_type").agg(m.rows().alias("event_count"))
    per_user = Window.partitionBy("user_id")
    ranked = counts.withColumn(
        "rank", F.row_number().over(per_user.orderBy(F.desc("event_count"), "event_type"))
    ).where(F.col("rank") <= k)
    shares = ranked.withColumn("percentage", pct(F.col("event_count"), F.sum("event_count").over(per_user)))
    entry = F.struct("rank", "event_type", "event_count", "percentage")
    return shares.groupBy("user_id").agg(
        F.transform(
            F.array_sort(F.collect_list(entry)), lambda e: e.dropFields("rank")
        ).alias("top_3_event_types" if k == 3 else f"top_{k}_event_types")
    )


# --- business --------------------------------------------------------------------------------


def daily_active_users(events: DataFrame) -> DataFrame:
    return (
        events.where("is_valid")
        .groupBy("event_date")
        .agg(
            m.distinct("user_id").alias("daily_active_users"),
            m.distinct("session_id").alias("daily_active_sessions"),
            m.rows().alias("total_events"),
            m.events_per("user_id").alias("avg_events_per_user"),
        )
    )


def revenue_metrics(events: DataFrame) -> DataFrame:
    paid = events.where(F.col("is_valid") & m.is_type("purchase") & F.col("amount").isNotNull())
    return paid.groupBy("event_date").agg(
        m.distinct("user_id").alias("purchasing_users"),
        m.rows().alias("total_purchases"),
        F.sum("amount").alias("total_revenue"),
        *[f("amount").alias(f"{n}_purchase_amount") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))],
    )


def user_cohorts(events: DataFrame, months: int = 4) -> DataFrame:
    """Monthly cohorts by first activity and how many users return k months later.

    Users are reduced to their active months first; the cohort is then the smallest of them, so no
    self-join is needed.
    """
    active = (
        events.where("is_valid")
        .select("user_id", month_of(F.col("event_date")).alias("month"))
        .distinct()
        .withColumn("cohort_month", F.min("month").over(Window.partitionBy("user_id")))
    )
    at = [F.col("month") == F.add_months("cohort_month", k) for k in range(months)]
    return active.groupBy("cohort_month").agg(
        F.count_if(at[0]).alias("cohort_size"),
        *[F.count_if(c).alias(f"month_{k}_retention") for k, c in enumerate(at)],
    )


def ml_user_features(events: DataFrame, as_of: AsOf, mode: str = ROWS) -> DataFrame:
    daily = (
        events.where("is_valid")
        .groupBy("user_id", "event_date")
        .agg(
            m.rows().alias("events_today"),
            m.distinct("event_type").alias("unique_event_types_today"),
            m.revenue().alias("revenue_today"),
        )
        .withColumn("days_since_last_event", F.datediff(as_of_date(as_of), "event_date"))
    )
    rolled, derived = {}, {}
    for n in (7, 30):
        names = {f"events_last_{n}_days": "events_today", f"revenue_last_{n}_days": "revenue_today"}
        rolled |= sums(trailing("user_id", "event_date", n, mode), **names)
        derived[f"avg_revenue_per_event_{n}d"] = ratio_or(
            F.col(f"revenue_last_{n}_days"), F.col(f"events_last_{n}_days"), 2, 0.0
        )
    return daily.withColumns(rolled).withColumns(derived)


def pruned_purchases(events: DataFrame, user_ids: Sequence[str], as_of: AsOf, days: int = 7) -> DataFrame:
    """Purchases of some users in recent partitions: partition pruning plus pushed-down keys."""
    wanted = since("event_date", days, as_of) & F.col("user_id").isin(*user_ids)
    return (
        events.where(wanted & m.is_type("purchase") & F.col("is_valid"))
        .groupBy("user_id", "event_type")
        .agg(m.rows().alias("event_count"), F.sum(F.coalesce("amount", F.lit(0.0))).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"))
    )


def user_type_daily(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id", "event_type", "event_date").agg(
        m.rows().alias("event_count"), F.sum("amount").alias("total_amount")
    )


# --- quality summaries -------------------------------------------------------------------------


def _validity(df: DataFrame, table: str, *extra: Column) -> DataFrame:
    ok = F.count_if(F.col("is_valid"))
    return df.agg(
        F.lit(table).alias("table_name"),
        m.rows().alias("total_rows"),
        ok.alias("valid_rows"),
        pct(ok, m.rows()).alias("validity_percentage"),
        *extra,
    )


def data_quality_summary(events: DataFrame, users: DataFrame) -> DataFrame:
    def part(df: DataFrame, table: str, day: str, types: Column) -> DataFrame:
        return _validity(
            df, table,
            F.count_if(~F.col("is_valid")).alias("invalid_rows"),
            m.distinct("user_id").alias("unique_users"),
            types.alias("unique_event_types"),
            F.min(day).alias("earliest_date"),
            F.max(day).alias("latest_date"),
        )

    parts = part(events, "events", "event_date", m.distinct("event_type")).unionByName(
        part(users, "users", "user_date", F.lit(None).cast("long"))
    )
    return parts.select(
        "table_name", "total_rows", "valid_rows", "invalid_rows", "validity_percentage",
        "unique_users", "unique_event_types", "earliest_date", "latest_date",
    )


def dag_quality_check(events: DataFrame, users: DataFrame, as_of: AsOf) -> DataFrame:
    """Validity of yesterday's events and users."""
    return _validity(events.where(on_previous_day("event_date", as_of)), "events").unionByName(
        _validity(users.where(on_previous_day("user_date", as_of)), "users")
    )


# --- raw-table starter queries -----------------------------------------------------------------


def trial_daily_events(raw: DataFrame, days: int = 10) -> DataFrame:
    return (
        raw.groupBy(F.to_date("event_timestamp").alias("date"))
        .agg(m.rows().alias("total_events"), m.distinct("user_id").alias("unique_users"))
        .orderBy(F.desc("date"))
        .limit(days)
    )


def trial_user_activity(raw: DataFrame, users: int = 10) -> DataFrame:
    return (
        raw.groupBy("user_id")
        .agg(m.rows().alias("total_events"), m.distinct("event_type").alias("unique_event_types"))
        .orderBy(F.desc("total_events"), "user_id")
        .limit(users)
    )


def trial_event_types(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("event_type")
        .agg(m.rows().alias("count"), m.distinct("user_id").alias("unique_users"))
        .orderBy(F.desc("count"))
    )


# --- mart reports ------------------------------------------------------------------------------


def kpi_last_days(business: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    return (
        business.where(since("date", days, as_of))
        .select("date", "daily_active_users", "daily_revenue")
        .orderBy(F.desc("date"))
    )


def engagement_report(analytics: DataFrame, as_of: AsOf) -> DataFrame:
    return (
        analytics.where(on_previous_day("date", as_of))
        .select("user_id", "engagement_score_7d", "engagement_score_30d", "preferred_platform", "value_segment")
        .orderBy(F.desc("engagement_score_7d"))
    )


def feature_read(features: DataFrame, as_of: AsOf) -> DataFrame:
    return features.where(on_previous_day("feature_date", as_of)).select(
        "user_id", "feature_date", "events_last_7_days", "events_last_30_days",
        "revenue_last_7_days", "revenue_last_30_days",
        "engagement_score_7d", "engagement_score_30d", "platform_diversity_score",
    )
