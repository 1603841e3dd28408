"""The tables: layer, partition date, clustering, unique key, retention and read guard."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    date_col: str
    keys: tuple[str, ...]
    cluster: tuple[str, ...]
    retention_days: int
    needs_filter: bool = True
    newest_first: tuple[str, ...] = ()
    arrival: str | None = None  # of two versions of a key from different loads the later arrival stays

    @property
    def key_fixes_date(self) -> bool:
        """True when a key can never move to another partition."""
        return self.date_col in self.keys


_EVENT_CLUSTER = ("user_id", "event_type", "platform")
_USER_CLUSTER = ("country", "subscription_tier")
_ALL = (
    Table("events", "raw", "event_date", ("event_id",), _EVENT_CLUSTER, 2555,
          newest_first=("event_timestamp", "created_at"), arrival="created_at"),
    Table("users", "raw", "user_date", ("user_id",), _USER_CLUSTER, 2555, False,
          newest_first=("updated_at", "created_at")),
    Table("sessions", "raw", "session_date", ("session_id",), ("user_id", "platform"), 2555,
          newest_first=("ended_at", "started_at")),
    Table("stg_events", "staging", "event_date", ("event_id",), _EVENT_CLUSTER, 1095,
          newest_first=("event_timestamp", "created_at"), arrival="created_at"),
    Table("stg_users", "staging", "user_date", ("user_id",), _USER_CLUSTER, 1095, False,
          newest_first=("updated_at", "created_at")),
    Table("stg_sessions", "staging", "session_date", ("session_id",), ("user_id", "platform"), 1095,
          newest_first=("ended_at", "started_at")),
    Table("user_metrics", "curated", "date", ("user_id", "date"), ("user_id",), 730),
    Table("event_metrics", "curated", "date", ("event_type", "date"), ("event_type",), 730),
    Table("user_registrations", "curated", "date", ("date", "registered_on"), ("registered_on",), 730),
    Table("ml_features", "curated", "feature_date", ("user_id", "feature_date"), ("user_id",), 365),
    Table("user_analytics", "mart", "date", ("user_id", "date"), ("user_id", "user_tier"), 365),
    Table("business_metrics", "mart", "date", ("date",), ("date",), 1095),
    Table("ml_training", "mart", "feature_date", ("user_id", "feature_date"), ("user_id",), 365),
)
TABLES: dict[str, Table] = {t.name: t for t in _ALL}

# Changed days of a table are pending for these until they have taken them over.  A changed row of
# stg_users has no day in user_metrics: there the daily batch marks the event days of the user.
DOWNSTREAM: dict[str, tuple[str, ...]] = {
    "events": ("stg_events",),
    "users": ("stg_users",),
    "sessions": ("stg_sessions",),
    "stg_events": ("user_metrics", "event_metrics"),
    "user_metrics": ("ml_features", "user_analytics", "business_metrics", "user_registrations", "user_windows"),
}
# Kept beside the tables, but catching up like one of them.
STATES = ("user_windows",)
