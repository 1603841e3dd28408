"""Raw -> staging: keep every row, flag the bad ones, unpack the payload once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.expressions import AsOf, as_of_date, as_of_ts, blank, json_texts, labels
from eventloom.sources.schemas import EMAIL_PATTERN

EVENT_FIELDS = ("amount", "currency", "product_id", "category", "page", "source", "campaign")
USER_FIELDS = ("source", "referral_code", "campaign", "platform")


def _length(name: str) -> Column:
    return F.length(F.coalesce(F.col(name), F.lit("")))


def stg_events(raw: DataFrame, as_of: AsOf) -> DataFrame:
    kept = raw.columns
    problems = labels(
        (blank(F.col("event_id")), "missing_event_id"),
        (blank(F.col("user_id")), "missing_user_id"),
        (blank(F.col("event_type")), "missing_event_type"),
        (F.col("event_timestamp").isNull(), "missing_event_timestamp"),
    )
    valid = ~(
        blank(F.col("event_id"))
        | blank(F.col("user_id"))
        | blank(F.col("event_type"))
        | F.col("event_timestamp").isNull()
    )
    measured = ("event_id", "user_id", "event_type")
    return json_texts(raw, "metadata", EVENT_FIELDS).select(
        *kept,
        valid.alias("is_valid"),
        problems.alias("validation_errors"),
        # A non-numeric amount must not kill the batch.
        F.col("amount").try_cast("double").alias("amount"),
        *EVENT_FIELDS[1:],
        *[_length(c).alias(f"{c}_length") for c in measured],
        as_of_ts(as_of).alias("processed_at"),
    )


def stg_users(raw: DataFrame, as_of: AsOf) -> DataFrame:
    email_ok = F.col("email").rlike(EMAIL_PATTERN)
    problems = labels(
        (blank(F.col("user_id")), "missing_user_id"),
        (blank(F.col("email")), "missing_email"),
        (F.col("created_at").isNull(), "missing_created_at"),
        (~email_ok, "invalid_email_format"),
    )
    valid = ~(blank(F.col("user_id")) | blank(F.col("email")) | F.col("created_at").isNull() | ~email_ok)
    today = as_of_date(as_of)
    return json_texts(raw, "metadata", USER_FIELDS).select(
        "user_id", "email", "created_at", "updated_at", "first_name", "last_name",
        # concat_ws skips NULLs: both names, either one, or ''.
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        "country",
        F.upper(F.trim(F.coalesce("country", F.lit("")))).alias("country_standardized"),
        "timezone",
        "subscription_tier",
        F.lower(F.trim(F.coalesce("subscription_tier", F.lit("basic")))).alias("subscription_tier_standardized"),
        "metadata",
        "user_date",
        valid.alias("is_valid"),
        problems.alias("validation_errors"),
        *USER_FIELDS,
        *[_length(c).alias(f"{c}_length") for c in ("user_id", "email")],
        F.datediff(today, F.to_date("created_at")).alias("days_since_registration"),
        F.datediff(today, F.to_date("updated_at")).alias("days_since_last_update"),
        as_of_ts(as_of).alias("processed_at"),
    )


def stg_sessions(raw: DataFrame, as_of: AsOf) -> DataFrame:
    backwards = F.col("ended_at") < F.col("started_at")
    problems = labels(
        (blank(F.col("session_id")), "missing_session_id"),
        (blank(F.col("user_id")), "missing_user_id"),
        (F.col("started_at").isNull(), "missing_started_at"),
        (backwards, "negative_duration"),
    )
    valid = ~(
        blank(F.col("session_id"))
        | blank(F.col("user_id"))
        | F.col("started_at").isNull()
        | F.coalesce(backwards, F.lit(False))
    )
    elapsed = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    return raw.withColumn("duration_seconds", F.coalesce("duration_seconds", elapsed)).select(
        *raw.columns,
        valid.alias("is_valid"),
        problems.alias("validation_errors"),
        as_of_ts(as_of).alias("processed_at"),
    )
