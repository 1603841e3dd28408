"""The fixed quality reports: eighteen row checks, and the monitor's combined report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.expressions import AsOf, as_of_date, as_of_ts, blank
from eventloom.functions.measures import rows
from eventloom.operators import quality as q
from eventloom.plans.views import on_previous_day
from eventloom.sources.lake import Lake
from eventloom.sources.schemas import EMAIL_PATTERN, EVENT_TYPES

CRITICAL = ("user_id", "event_id", "event_type", "event_timestamp")
FRESHNESS = {
    "stg_events": "event_timestamp",
    "stg_users": "created_at",
    "user_metrics": "date",
    "event_metrics": "date",
    "business_metrics": "date",
}
# Minutes a layer may lag.
LAYER_SLA = {"raw": 15, "staging": 60, "curated": 240, "mart": 360}


def _invalid_type() -> Column:
    return ~F.col("event_type").isin(*EVENT_TYPES)


def invalid_types(events: DataFrame) -> DataFrame:
    """Rows with an event type outside the accepted list; a NULL type is not reported."""
    return events.where(_invalid_type())


def _row_checks(as_of: AsOf) -> dict[str, dict[str, Column]]:
    now = as_of_ts(as_of)

    def outside(c: str) -> Column:
        return ~F.col(c).between(0, 100)

    return {
        "stg_events": {
            "null_event_ids": blank(F.col("event_id")),
            "null_user_ids": blank(F.col("user_id")),
            "null_event_types": blank(F.col("event_type")),
            "stale_data": F.col("event_date") < F.date_sub(as_of_date(as_of), 7),
            "invalid_event_types": _invalid_type(),
            "negative_amounts": F.col("amount") < 0,
            "future_event_timestamps": F.col("event_timestamp") > now,
        },
        "stg_users": {
            "null_user_ids": blank(F.col("user_id")),
            "null_emails": blank(F.col("email")),
            "invalid_emails": ~F.col("email").rlike(EMAIL_PATTERN),
            "future_created_at": F.col("created_at") > now,
        },
        "user_metrics": {
            "negative_events": F.col("total_events") < 0,
            "negative_revenue": F.col("total_revenue") < 0,
            "inconsistent_purchases": (F.col("total_purchases") > 0) & (F.col("total_revenue") == 0),
        },
        "business_metrics": {
            "missing_dau": F.col("daily_active_users").isNull() | (F.col("daily_active_users") < 0),
        },
        "ml_features": {
            "invalid_engagement_scores": outside("engagement_score_7d") | outside("engagement_score_30d"),
        },
    }


SURPLUS = {"stg_events": ("event_id", "duplicate_event_ids"), "stg_users": ("user_id", "duplicate_user_ids")}


def quality_checks(tables: Mapping[str, DataFrame], as_of: AsOf) -> DataFrame:
    """(model_name, test_name, failed_rows), one row per check whether it fails or not.

    One aggregate per table covers its row checks.  The surplus-copies counts are kept apart from
    it: mixed in, every event id would drag all other counters through its shuffle.
    """
    parts = []
    for table, checks in _row_checks(as_of).items():
        counted = tables[table].agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])
        entries = [
            {"model_name": F.lit(table), "test_name": F.lit(n), "failed_rows": F.col(n)} for n in checks
        ]
        parts.append(q.unpivot_row(counted, entries))
    for table, (key, name) in SURPLUS.items():
        copies = tables[table].groupBy(key).agg(rows().alias("n"))
        surplus = F.sum("n") - F.count(key)  # groups: NULL keys count as copies of nothing
        parts.append(
            copies.agg(F.coalesce(surplus, F.lit(0)).alias("failed_rows")).select(
                F.lit(table).alias("model_name"), F.lit(name).alias("test_name"), "failed_rows"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def freshness_report(tables: Mapping[str, DataFrame], as_of: AsOf, max_hours: float = 4) -> DataFrame:
    parts = [q.freshness(tables[t], t, c, as_of, max_hours) for t, c in FRESHNESS.items()]
    return reduce(DataFrame.unionByName, parts)


def null_profiles(events: DataFrame, users: DataFrame, as_of: AsOf) -> DataFrame:
    return q.null_profile(
        events.where(on_previous_day("event_date", as_of)), "stg_events", CRITICAL
    ).unionByName(q.null_profile(users.where(on_previous_day("user_date", as_of)), "stg_users", CRITICAL))


def duplicate_profiles(events: DataFrame, users: DataFrame, as_of: AsOf) -> DataFrame:
    return q.duplicate_rows(
        events.where(on_previous_day("event_date", as_of)), "stg_events"
    ).unionByName(q.duplicate_rows(users.where(on_previous_day("user_date", as_of)), "stg_users"))


def business_rules(events: DataFrame, metrics: DataFrame, as_of: AsOf) -> DataFrame:
    """Rule violations of the previous day."""
    from_events = events.where(on_previous_day("event_date", as_of)).agg(
        F.count_if(F.col("event_timestamp") > as_of_ts(as_of)).alias("future_timestamp"),
        F.count_if(_invalid_type()).alias("invalid_event_types"),
    )
    from_metrics = metrics.where(on_previous_day("date", as_of)).agg(
        F.count_if(F.col("total_revenue") < 0).alias("negative_revenue")
    )

    def entries(df: DataFrame) -> DataFrame:
        return q.unpivot_row(df, [{"rule": F.lit(c), "violations": F.col(c)} for c in df.columns])

    return entries(from_metrics).unionByName(entries(from_events))


def quality_report(tables: Mapping[str, DataFrame], as_of: AsOf, newest: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All monitor checks as (check_name, item, value, status).

    ``newest`` holds what is enough of each table for its newest value; everything else looks at the
    previous day alone.
    """
    events, users = tables["stg_events"], tables["stg_users"]

    def shaped(df: DataFrame, name: Column, item: Column, value: Column, status: Column) -> DataFrame:
        return df.select(
            name.alias("check_name"), item.alias("item"), value.cast("double").alias("value"), status.alias("status")
        )

    ok = F.lit("success")
    fresh = shaped(
        freshness_report(newest or tables, as_of), F.concat("table_name", F.lit("_freshness")),
        F.lit("hours_behind"), F.col("hours_behind"), F.col("status"),
    )
    nulls = shaped(
        null_profiles(events, users, as_of), F.concat("table_name", F.lit("_quality")),
        F.concat(F.lit("null_"), "column_name"), F.col("null_count"), ok,
    )
    copies = shaped(
        duplicate_profiles(events, users, as_of), F.concat("table_name", F.lit("_quality")),
        F.lit("duplicate_rows"), F.col("duplicate_count"), ok,
    )
    rules = shaped(
        business_rules(events, tables["user_metrics"], as_of), F.lit("business_rules"),
        F.col("rule"), F.col("violations"), F.when(F.col("violations") > 0, "warning").otherwise("success"),
    )
    return reduce(DataFrame.unionByName, [fresh, nulls, copies, rules])


def lake_report(lake: Lake, as_of: AsOf) -> DataFrame:
    """The report of stored tables: it reads the previous day and the newest partition of each."""
    return quality_report({n: lake.read(n) for n in FRESHNESS}, as_of, {n: lake.newest(n) for n in FRESHNESS})


def alerts(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") != "success")


def save_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# Layer -> its table and the column that says how far it has come; both fix the partition date.
LAYERS = {
    "raw": ("events", "event_timestamp"),
    "staging": ("stg_events", "event_timestamp"),
    "curated": ("user_metrics", "date"),
    "mart": ("business_metrics", "date"),
}


def lake_slas(lake: Lake, as_of: AsOf) -> DataFrame:
    """The lag of every layer of stored tables, from the newest partition of each."""
    return layer_slas({layer: (t, lake.newest(t), c) for layer, (t, c) in LAYERS.items()}, as_of)


def layer_slas(tables: Mapping[str, tuple[str, DataFrame, str]], as_of: AsOf) -> DataFrame:
    """{layer: (table name, table, time column)} against the layer's allowed lag."""
    parts = [q.layer_sla(df, layer, t, c, as_of, LAYER_SLA[layer]) for layer, (t, df, c) in tables.items()]
    return reduce(DataFrame.unionByName, parts)
