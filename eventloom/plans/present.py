"""Stored models as of any run time.

Ages depend on the run time, so every stored row would change every day.  Instead a row keeps the ages
of the run that wrote it, whose time it carries, and is brought to another run time when it is read.
The only counts of users by age, the new users of a day, come from a small table of users per day and
registration date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.expressions import AsOf, as_of_date, as_of_ts, pct
from eventloom.functions.measures import rows
from eventloom.plans.curated import lifecycle_stage

# Model -> (the stamp of the run that wrote a row, the ages in days).
AGES = {
    "stg_users": ("processed_at", ("days_since_registration", "days_since_last_update")),
    "user_metrics": ("last_updated", ("days_since_registration",)),
    "ml_features": ("last_updated", ("days_since_registration", "days_since_last_event", "days_since_last_purchase")),
    "user_analytics": ("last_updated", ("days_since_registration",)),
}


def registered_on(stamp: str) -> Column:
    """The registration date behind the age that a run with this stamp wrote."""
    return F.date_sub(F.to_date(stamp), F.col("days_since_registration"))


def registrations(metrics: DataFrame) -> DataFrame:
    """Users per day and registration date."""
    return metrics.groupBy("date", registered_on("last_updated").alias("registered_on")).agg(rows().alias("users"))


def presented(name: str, df: DataFrame, as_of: AsOf, registered: DataFrame | None = None) -> DataFrame:
    """A stored model as a run at ``as_of`` would have written it; ``business_metrics`` also needs the
    ``registrations`` of the user days."""
    if name == "business_metrics":
        return _business(df, registered, as_of)
    if name not in AGES:
        return df
    stamp, ages = AGES[name]
    later = F.datediff(as_of_date(as_of), F.to_date(stamp))
    out = df.withColumns({c: F.col(c) + later for c in ages})
    if name == "ml_features":
        out = out.withColumn("lifecycle_stage", lifecycle_stage())
    return out.withColumn(stamp, as_of_ts(as_of)).select(df.columns)


def _business(df: DataFrame, registered: DataFrame, as_of: AsOf) -> DataFrame:
    age = F.datediff(as_of_date(as_of), F.col("registered_on"))
    new = {"new_users": age == 0, "new_users_this_week": age.between(1, 7), "new_users_this_month": age.between(1, 30)}
    counted = registered.where(age.between(0, 30)).groupBy("date").agg(*[F.sum(F.when(c, F.col("users")).otherwise(0)).alias(n) for n, c in new.items()])
    rest = df.drop(*new).join(counted, "date", "left").withColumns({n: F.coalesce(n, F.lit(0)).cast("long") for n in new})
    rest = rest.withColumns({"new_user_rate": pct(F.col("new_users"), F.col("daily_active_users")), "last_updated": as_of_ts(as_of)})
    return rest.select(df.columns)
