"""Raw events and users derived from the star-schema tables (events, customer).

Those tables carry no sessions, devices or JSON payloads, so the missing columns are computed
from the row key, together with the usual defects: empty user ids, purchases without an amount,
missing sessions, bad e-mails, spaced and cased tiers.  No row is filtered out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pick(number: Column, *choices: str | None) -> Column:
    """choices[number % len(choices)]"""
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (number % len(choices) + 1).cast("int"))


def events_from(source: DataFrame) -> DataFrame:
    """Works on a batch or a streaming read of the ``events`` table."""
    eid, uid, kind = F.col("event_id"), F.col("user_id").cast("string"), F.col("event_type")
    at = F.col("ts").cast("timestamp")
    day = F.to_date("ts")
    eid_text = eid.cast("string")
    product = F.concat(F.lit('"product_id": "prod_'), (eid % 10).cast("string"), F.lit('"'))
    category = F.concat(F.lit('"category": "cat_'), (eid % 6).cast("string"), F.lit('"}'))
    purchase = F.concat(
        F.lit('{"amount": '), F.col("value").cast("string"),
        F.lit(', "currency": "'), _pick(eid, "USD", "EUR", "GBP", "CAD"), F.lit('", '),
        product, F.lit(", "), category,
    )
    payload = (
        F.when((kind == "purchase") & (eid % 20 == 0), F.concat(F.lit('{"currency": "USD", '), product, F.lit("}")))
        .when(kind == "purchase", purchase)
        .when(kind == "view", F.concat(F.lit('{"page": "/p'), (eid % 5).cast("string"), F.lit('", '), category))
        .otherwise(F.col("props"))
    )
    quarter = F.floor(F.hour("ts") / 6).cast("int").cast("string")
    return source.select(
        eid_text.alias("event_id"),
        F.when(eid % 97 == 0, "").otherwise(uid).alias("user_id"),
        F.when(kind == "view", "page_view")
        .when((eid % 11 == 0) & (kind == "click"), "login")
        .otherwise(kind)
        .alias("event_type"),
        at.alias("event_timestamp"),
        F.when(eid % 53 != 0, F.concat_ws("-", uid, day.cast("string"), quarter)).alias("session_id"),
        _pick(eid, "desktop", "mobile", "tablet", "other").alias("device_type"),
        _pick(eid, "ios", "web", "mobile", "web", None).alias("platform"),
        F.lit("1.0.0").alias("app_version"),
        payload.alias("metadata"),
        (at + F.expr("INTERVAL 1 MINUTE")).alias("created_at"),
        day.alias("event_date"),
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return events_from(spark.read.parquet(f"{folder}/events.parquet"))


def with_gaps(raw: DataFrame) -> DataFrame:
    """Raw events of which some have no timestamp (hence no date), no id, or a blank one."""
    number = F.col("event_id").cast("long")
    timed = number % 101 != 7
    return raw.withColumns(
        {
            "event_timestamp": F.when(timed, F.col("event_timestamp")),
            "event_date": F.when(timed, F.col("event_date")),
            "event_id": F.when(number % 107 == 11, "").when(number % 103 != 9, F.col("event_id")),
        }
    )


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    created = F.date_add(F.lit("2023-10-01").cast("date"), (key % 120).cast("int")).cast("timestamp")
    touched = F.date_add(F.to_date(created), (key % 20).cast("int")).cast("timestamp")
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    return customers.select(
        key.cast("string").alias("user_id"),
        F.when(key % 50 == 7, "not-an-email")
        .when(key % 50 != 9, F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")))
        .alias("email"),
        created.alias("created_at"),
        F.when(key % 3 != 0, touched).alias("updated_at"),
        F.when(key % 6 != 0, "Cust").alias("first_name"),
        F.substring("c_name", 10, 100).alias("last_name"),
        _pick(F.col("c_nationkey"), "US", " ca ", "uk", "DE", None).alias("country"),
        F.lit("UTC").alias("timezone"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Premium")
        .when(F.col("c_mktsegment") == "BUILDING", "basic")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "enterprise")
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit(None))
        .otherwise(" BASIC ")
        .alias("subscription_tier"),
        F.concat(
            F.lit('{"source": "'), _pick(key, "organic", "ads", "social"),
            F.lit('", "campaign": "c'), (key % 4).cast("string"),
            F.lit('", "referral_code": null, "platform": {"os": "x"}}'),
        ).alias("metadata"),
        F.to_date(created).alias("user_date"),
    )
