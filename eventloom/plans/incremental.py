"""Incremental versions of the models: read the history a slice needs, emit only its own dates.

``since`` is the first date of the slice.  Running the slices in order gives the same tables as
one full refresh.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.expressions import AsOf
from eventloom.plans import curated, mart


def slice_user_metrics(events: DataFrame, users: DataFrame, since: dt.date, as_of: AsOf) -> DataFrame:
    """Whole days from ``since`` on."""
    return curated.user_metrics(events.where(F.col("event_date") >= F.lit(since)), users, as_of)


def slice_event_metrics(
    events: DataFrame, previous: DataFrame | None, since: dt.date, as_of: AsOf
) -> DataFrame:
    """Days from ``since`` on; growth needs each type's last earlier row, taken from the table itself."""
    daily = curated.daily_event_type_activity(events.where(F.col("event_date") >= F.lit(since)))
    if previous is not None:
        earlier = previous.where(F.col("date") < F.lit(since)).select(*daily.columns)
        last = (
            earlier.groupBy("event_type")
            .agg(F.max_by(F.struct(*daily.columns), "date").alias("row"))
            .select("row.*")
        )
        daily = last.unionByName(daily)
    return curated.with_event_growth(daily, as_of).where(F.col("date") >= F.lit(since))


def patch_event_metrics(changed: DataFrame, stored: DataFrame, days: set[dt.date], as_of: AsOf) -> DataFrame:
    """Days from the first changed one on, from the events of the changed days and the stored rest.

    Growth compares with a type's row before, so later days change with it; their own measures do not.
    """
    daily = curated.daily_event_type_activity(changed)
    since = min(days)
    own = stored.where(F.col("date") >= F.lit(since)).where(~F.col("date").isin(list(days)))
    before = stored.where(F.col("date") < F.lit(since)).groupBy("event_type").agg(F.max_by(F.struct(*daily.columns), "date").alias("row")).select("row.*")
    everything = daily.unionByName(own.select(*daily.columns)).unionByName(before)
    return curated.with_event_growth(everything, as_of).where(F.col("date") >= F.lit(since))


def business_bounds(since: dt.date, days: list[dt.date]) -> tuple[dt.date, dt.date]:
    """(first date to read, first date to emit) given the dates that exist.

    A new day changes the weekly and monthly users of its whole week and month, so those are
    emitted again, and thirty earlier days feed the rolling averages of the first of them.
    """
    week = since - dt.timedelta(days=(since.weekday() + 1) % 7)
    emit = min(since.replace(day=1), week)
    earlier = sorted(d for d in days if d < emit)[-30:]
    # Weeks and months must be whole from `emit` on, which they are: it starts one of each or
    # lies inside a month that began earlier.
    start = min([emit, emit.replace(day=1), *earlier])
    return start, emit


def slice_business_metrics(metrics: DataFrame, since: dt.date, days: list[dt.date], as_of: AsOf) -> DataFrame:
    read_from, emit_from = business_bounds(since, days)
    out = mart.business_metrics(metrics.where(F.col("date") >= F.lit(read_from)), as_of)
    return out.where(F.col("date") >= F.lit(emit_from))
