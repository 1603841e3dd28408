"""Ordered conversion funnel without ever holding one user's whole history in a task.

A user reaches step i when the first event of its type at or after the time step i-1 was reached
exists.  Time is cut into buckets.  Inside a (user, bucket) group a chain of windows tells, for
each step a user could arrive with, the step they leave with.  Those small transitions are then
composed in time order per user; their number is bounded by the buckets of the date range, not
by the events, so even a user with a third of all events is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.expressions import pct


def _leaving_steps(steps: Sequence[str], df: DataFrame, bucket: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """For each arriving step, the step reached by the end of the bucket."""
    w = Window.partitionBy(*bucket)
    n = len(steps)
    reached: dict[tuple[int, int], str] = {}
    # Round d adds the time of step start+d for every arriving step; one projection per round.
    for d in range(1, n + 1):
        cols = {}
        for start in range(n - d + 1):
            step = start + d
            match = F.col("event_type") == steps[step - 1]
            if d > 1:
                match = match & (F.col("event_timestamp") >= F.col(reached[start, step - 1]))
            name = f"_t_{start}_{step}"
            cols[name] = F.min(F.when(match, F.col("event_timestamp"))).over(w)
            reached[start, step] = name
        df = df.withColumns(cols)
    leaving = []
    for start in range(n + 1):
        got = [F.col(reached[start, s]).isNotNull().cast("int") for s in range(start + 1, n + 1)]
        leaving.append(sum(got, F.lit(start)))
    return df, leaving


def conversion_funnel(
    events: DataFrame,
    steps: Sequence[str],
    date_from: str,
    date_to: str,
    per: Sequence[str] = (),
    bucket: str = "HOUR",
) -> DataFrame:
    """Users reaching each step, with the rate against the previous and the first step.

    ``per`` splits the range, for example by ``event_date`` for one funnel per day.
    """
    keys = [*per, "user_id", "_bucket"]
    relevant = (
        events.where("is_valid")
        .where(F.col("event_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
        .where(F.col("event_type").isin(*steps))
        .select(*per, "user_id", "event_type", "event_timestamp", F.date_trunc(bucket, "event_timestamp").alias("_bucket"))
        .distinct()
    )
    timed, leaving = _leaving_steps(steps, relevant, keys)
    moves = timed.groupBy(*keys).agg(*[F.first(c).alias(f"_from_{i}") for i, c in enumerate(leaving)])
    move = F.array(*[F.col(f"_from_{i}") for i in range(len(steps) + 1)])
    furthest = moves.groupBy(*per, "user_id").agg(
        F.aggregate(
            F.array_sort(F.collect_list(F.struct("_bucket", move.alias("move")))),
            F.lit(0),
            lambda at, m: F.element_at(m["move"], at + 1),
        ).alias("reached")
    )
    counts = furthest.groupBy(*per).agg(*[F.count_if(F.col("reached") >= i).alias(f"s{i}") for i in range(1, len(steps) + 1)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(s).alias("event_type"),
                F.col(f"s{i}").alias("users"),
                pct(F.col(f"s{i}"), F.col(f"s{max(i - 1, 1)}")).alias("step_rate"),
                pct(F.col(f"s{i}"), F.col("s1")).alias("overall_rate"),
            )
            for i, s in enumerate(steps, 1)
        ]
    )
    return counts.select(*per, F.inline(rows))
