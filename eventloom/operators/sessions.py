"""Sessions out of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.measures import is_type, rows


def sessions_from_events(events: DataFrame) -> DataFrame:
    """One row per session id.  Descriptive columns come from the session's first event.

    min/max/count and min_by all combine before the exchange, so a hot session id is no problem.
    """
    order = F.struct("event_timestamp", "event_id")
    first = F.min_by(F.struct("user_id", "device_type", "platform"), order)
    grouped = events.groupBy("session_id").agg(
        first.alias("first"),
        F.min("event_timestamp").alias("started_at"),
        F.max("event_timestamp").alias("ended_at"),
        F.count_if(is_type("page_view")).alias("page_views"),
        rows().alias("events_count"),
    )
    return grouped.select(
        "session_id",
        F.col("first.user_id").alias("user_id"),
        "started_at",
        "ended_at",
        F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at")).alias("duration_seconds"),
        "page_views",
        "events_count",
        F.col("first.device_type").alias("device_type"),
        F.col("first.platform").alias("platform"),
        F.lit(None).cast("string").alias("country"),
        F.lit("{}").alias("metadata"),
        F.to_date("started_at").alias("session_date"),
    )


def _bucket(gap_seconds: int) -> Column:
    return F.floor(F.unix_micros("event_timestamp") / (gap_seconds * 1_000_000))


def activity(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Events of each user per stretch of ``gap_seconds``: such a stretch never holds two sessions.

    These partial results add up: those of several inputs, summed by user and stretch, are those of
    their union.  They combine before the exchange, so a user with very many events is no hot key.
    """
    return events.groupBy("user_id", _bucket(gap_seconds).alias("stretch")).agg(
        rows().alias("events_count"),
        F.count_if(is_type("page_view")).alias("page_views"),
        F.min("event_timestamp").alias("started_at"),
        F.max("event_timestamp").alias("ended_at"),
    )


def merged_activity(parts: DataFrame) -> DataFrame:
    """Partial results of several inputs as one per user and stretch."""
    return parts.groupBy("user_id", "stretch").agg(
        F.sum("events_count").alias("events_count"), F.sum("page_views").alias("page_views"),
        F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"),
    )


def stitched(stretches: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Sessions from ``activity``: consecutive stretches belong together unless more than the gap lies
    between the last event of one and the first of the next.

    Sorted per user are stretches, at most 48 a day for half an hour, however many events they hold.
    """
    by_time = Window.partitionBy("user_id").orderBy("stretch")
    before = F.lag("ended_at").over(by_time)
    opens = F.coalesce(F.unix_micros("started_at") - F.unix_micros(before) > gap_seconds * 1_000_000, F.lit(True))
    numbered = stretches.withColumn("_opens", opens.cast("int")).withColumn("_session", F.sum("_opens").over(by_time))
    return numbered.groupBy("user_id", "_session").agg(
        F.sum("events_count").alias("events_count"), F.sum("page_views").alias("page_views"),
        F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"),
    ).drop("_session")


def sessions_by_gap(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Activity sessions per user: a new one starts after more than ``gap_seconds`` without events."""
    return stitched(activity(events, gap_seconds), gap_seconds)
