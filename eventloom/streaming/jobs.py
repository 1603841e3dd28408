"""Structured Streaming versions of staging, de-duplication, daily metrics and sessions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.functions.expressions import AsOf
from eventloom.functions.measures import is_type, revenue, rows
from eventloom.plans.staging import stg_events
from eventloom.sources.lake import Lake


def stage_into(
    lake: Lake,
    raw: DataFrame,
    checkpoint: str,
    as_of: AsOf | None = None,
    name: str = "stg_events",
    search_back_days: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stage a raw event stream; every micro-batch is upserted, so a replayed batch changes nothing.

    Without ``as_of`` each batch is stamped with the time it is processed.  ``trigger`` is what
    ``DataStreamWriter.trigger`` takes, such as {"processingTime": "1 minute"}; by default
    everything available is staged and the query ends.
    """

    def land(batch: DataFrame, _: int) -> None:
        now = as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        lake.upsert(name, stg_events(batch, now), search_back_days)

    writer = raw.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def deduplicated(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First copy of each event id; state is kept no longer than the allowed delay."""
    return events.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def daily_type_metrics(staged: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Events, exact distinct users and revenue per event type and day.

    Two chained windowed aggregations: per user first, then per type.  That gives the exact distinct
    count streams otherwise refuse, and it spreads a huge event type over its users.
    """
    per_user = (
        staged.where("is_valid")
        .withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", "1 day"), "event_type", "user_id")
        .agg(
            rows().alias("n"),
            revenue().alias("earned"),
            F.count_if(is_type("purchase")).alias("purchases"),
        )
    )
    return (
        per_user.groupBy(F.window("window", "1 day"), "event_type")
        .agg(
            F.sum("n").alias("total_events"),
            rows().alias("unique_users"),
            F.sum("earned").alias("total_revenue"),
            F.sum("purchases").alias("total_purchases"),
        )
        .select(
            "event_type",
            F.to_date("window.start").alias("date"),
            "total_events", "unique_users", "total_revenue", "total_purchases",
        )
    )


def user_sessions(staged: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Activity sessions per user: a new one starts after ``gap`` without events.

    Works on batch input too, where the watermark is ignored.
    """
    return (
        staged.where("is_valid")
        .withWatermark("event_timestamp", delay)
        .groupBy("user_id", F.session_window("event_timestamp", gap))
        .agg(
            rows().alias("events_count"),
            F.count_if(is_type("page_view")).alias("page_views"),
            F.min("event_timestamp").alias("started_at"),
            F.max("event_timestamp").alias("ended_at"),
        )
        .drop("session_window")
    )


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over everything available into an append-only parquet folder and read that back."""
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark: SparkSession = df.sparkSession
    return spark.read.schema(df.schema).parquet(path)
