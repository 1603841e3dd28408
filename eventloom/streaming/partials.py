"""Streams that deliver open windows: partial results per micro-batch, summed when they are read.

Append mode delivers a window once it is closed.  Here every micro-batch leaves its own partial
aggregates, one small folder named by the batch, so a replayed batch replaces itself and every event
counts once.  A read sums the partials: days and sessions that are still open are in it, and late events
are never dropped.  After MAX_BATCHES the partials are merged into one set of files.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventloom.functions.measures import is_type, revenue, rows
from eventloom.operators.sessions import activity, merged_activity, stitched
from eventloom.sources import paths

MAX_BATCHES = 100


class Partials:
    """The partial results of one stream below a folder.

    ``partial`` turns events into partial results, ``merge`` sums partial results of several batches; merging
    must not care about order or grouping.  Results are partitioned by their column ``date``.
    """

    def __init__(self, spark: SparkSession, where: str, partial: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame]):
        self.spark, self.where, self.partial, self.merge = spark, where.rstrip("/"), partial, merge

    def _meta(self) -> dict:
        path = f"{self.where}/meta.json"
        return json.loads(paths.read_text(self.spark, path)) if paths.exists(self.spark, path) else {"upto": -1, "schema": None}

    def _batches(self, after: int) -> list[int]:
        found = (int(c.removeprefix("batch-")) for c in paths.children(self.spark, self.where) if c.startswith("batch-"))
        return sorted(n for n in found if n > after)

    def land(self, batch: DataFrame, number: int) -> None:
        """The partial results of one micro-batch; a batch that was merged already is not taken again."""
        meta = self._meta()
        if number <= meta["upto"]:
            return
        found = self.partial(batch)
        if meta["schema"] is None:
            meta["schema"] = found.schema.json()
            paths.make(self.spark, self.where)
            paths.write_text(self.spark, f"{self.where}/meta.json", json.dumps(meta))
        found.hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(f"{self.where}/batch-{number}")
        if len(self._batches(meta["upto"])) > MAX_BATCHES:
            self._compact(number)

    def _compact(self, upto: int) -> None:
        """One set of files for all batches so far; the old ones go after the new ones are named."""
        meta = self._meta()
        self.read().hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(f"{self.where}/merged-{upto}")
        old = [f"batch-{n}" for n in self._batches(-1) if n <= upto] + [f"merged-{meta['upto']}"]
        paths.write_text(self.spark, f"{self.where}/meta.json", json.dumps({**meta, "upto": upto}))
        for child in old:
            paths.remove(self.spark, f"{self.where}/{child}")

    def read(self) -> DataFrame:
        """All partial results so far, summed; a filter on ``date`` prunes."""
        meta = self._meta()
        schema = StructType.fromJson(json.loads(meta["schema"]))
        folders = [f"merged-{meta['upto']}"] if meta["upto"] >= 0 else []
        folders += [f"batch-{n}" for n in self._batches(meta["upto"])]
        parts = [self.spark.read.schema(schema).parquet(f"{self.where}/{f}").select(*schema.fieldNames()) for f in folders]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        return self.merge(whole)

    def run(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Take a stream of staged events; by default everything available, then the query ends."""
        writer = events.writeStream.foreachBatch(self.land).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def type_users(spark: SparkSession, where: str) -> Partials:
    """Per event type, day and user: events, revenue and purchases."""
    keys = ["event_type", "date", "user_id"]

    def partial(events: DataFrame) -> DataFrame:
        daily = events.where("is_valid").groupBy("event_type", F.to_date("event_timestamp").alias("date"), "user_id")
        return daily.agg(rows().alias("n"), revenue().alias("earned"), F.count_if(is_type("purchase")).alias("purchases"))

    return Partials(spark, where, partial, lambda p: p.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "earned", "purchases")]))


def daily_type_metrics(partials: Partials) -> DataFrame:
    """Events, exact distinct users and revenue per event type and day, open days included."""
    return partials.read().groupBy("event_type", "date").agg(
        F.sum("n").alias("total_events"), rows().alias("unique_users"), F.sum("earned").alias("total_revenue"), F.sum("purchases").alias("total_purchases")
    )


def user_activity(spark: SparkSession, where: str, gap_seconds: int = 1800) -> Partials:
    """Per user and stretch of the session gap: what sessions are stitched from."""

    def dated(parts: DataFrame) -> DataFrame:
        return parts.withColumn("date", F.to_date(F.timestamp_seconds(F.col("stretch") * gap_seconds)))

    return Partials(spark, where, lambda e: dated(activity(e.where("is_valid"), gap_seconds)), lambda p: dated(merged_activity(p)))


def user_sessions(partials: Partials, gap_seconds: int = 1800) -> DataFrame:
    """Activity sessions per user, open ones included."""
    return stitched(partials.read(), gap_seconds)
