"""Declared schemas of the raw tables and the value lists the models refer to."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _required(name: str, kind: DataType) -> StructField:
    return StructField(name, kind, False)


def _optional(name: str, kind: DataType) -> StructField:
    return StructField(name, kind, True)


# The columns of the raw tables.
EVENTS = StructType(
    [
        _required("event_id", StringType()),
        _required("user_id", StringType()),
        _required("event_type", StringType()),
        _required("event_timestamp", TimestampType()),
        _optional("session_id", StringType()),
        _optional("device_type", StringType()),
        _optional("platform", StringType()),
        _optional("app_version", StringType()),
        _optional("metadata", StringType()),
        _optional("created_at", TimestampType()),
    ]
)
USERS = StructType(
    [
        _required("user_id", StringType()),
        _required("email", StringType()),
        _required("created_at", TimestampType()),
        _optional("updated_at", TimestampType()),
        _optional("first_name", StringType()),
        _optional("last_name", StringType()),
        _optional("country", StringType()),
        _optional("timezone", StringType()),
        _optional("subscription_tier", StringType()),
        _optional("metadata", StringType()),
    ]
)
SESSIONS = StructType(
    [
        _required("session_id", StringType()),
        _required("user_id", StringType()),
        _required("started_at", TimestampType()),
        _optional("ended_at", TimestampType()),
        _optional("duration_seconds", LongType()),
        _optional("page_views", LongType()),
        _optional("events_count", LongType()),
        _optional("device_type", StringType()),
        _optional("platform", StringType()),
        _optional("country", StringType()),
        _optional("metadata", StringType()),
    ]
)

# Accepted domains and the e-mail pattern.
EVENT_TYPES = (
    "purchase", "page_view", "signup", "login", "logout",
    "click", "scroll", "search", "filter", "sort",
    "error", "exception", "crash", "session_start", "session_end",
)
PLATFORMS = ("web", "mobile", "desktop", "tablet")
DEVICE_TYPES = ("desktop", "mobile", "tablet", "other")
TIERS = ("basic", "premium", "enterprise")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
