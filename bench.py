"""Headline timings on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from eventloom import build_session  # noqa: E402
from eventloom.checks.queries import AS_OF, QUERIES, scratch_lake  # noqa: E402
from eventloom.plans import daily  # noqa: E402
from eventloom.sources import star_schema as star  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "stg_events", "user_metrics", "event_metrics", "ml_features", "user_analytics", "business_metrics",
    "user_cohorts", "user_event_preferences", "conversion_funnel", "sessions_from_events", "quality_checks",
)
REPEATS = 3


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    consume(spark.read.parquet(f"{FOLDER}/events.parquet"))  # start the JVM's parquet path

    seconds = {}
    for name in HEADLINE:
        runs = [timed(lambda: consume(QUERIES[name](spark, FOLDER))) for _ in range(REPEATS)]
        seconds[name] = statistics.median(runs)

    # All models from scratch, then one more day on top of them.
    lake, raw = scratch_lake(spark), star.raw_events(spark, FOLDER)
    last = raw.agg(F.max("event_date")).first()[0]
    lake.replace("users", star.raw_users(spark, FOLDER))
    lake.replace("events", raw.where(F.col("event_date") <= F.lit(last - dt.timedelta(days=1))))
    seconds["full_refresh"] = timed(lambda: consume(daily.run_models(lake, AS_OF, enforce=())))
    seconds["one_day_upsert"] = timed(lambda: consume(daily.run_day(lake, raw, last, AS_OF, enforce=())))

    seconds = {k: round(v, 3) for k, v in seconds.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
