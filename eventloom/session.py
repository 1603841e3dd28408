"""Session factory.  On a cluster the submitted configuration wins; this only fills gaps."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the sizing: shuffles start as wide as ``input_bytes`` asks for and are
# coalesced to the advisory size, skewed join and rebalance partitions are split at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Streams merge the sessions of each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Call-site capture for every column expression makes building wide plans several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


PARTITION_BYTES = 128 * 2**20


def shuffle_width(input_bytes: int) -> int:
    """Partitions that shuffles start with: about 128 MB each, coalescing can only lower them."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(app: str = "eventloom", master: str | None = None, input_bytes: int | None = None, **conf: str) -> SparkSession:
    """``input_bytes``: the size of the largest input, from which the width of shuffles follows."""
    if input_bytes is not None:
        conf = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_width(input_bytes)), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
