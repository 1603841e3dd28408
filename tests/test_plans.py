"""Plan shapes that must hold at scale, and results under a hot key."""

import re

import pytest
from pyspark.sql import functions as F

from eventloom.checks.queries import AS_OF, FUNNEL, QUERIES, Layers
from eventloom.operators.funnel import conversion_funnel
from eventloom.plans import curated, mart, staging, views
from eventloom.sources import star_schema as star
from eventloom.sources.lake import spread
from tests.conftest import SF, rows_of


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|Single|Round)", plan(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The user-day metrics as a table, as the daily run reads them."""
    path = str(tmp_path_factory.mktemp("stored") / "user_metrics")
    Layers(spark, SF).metrics.write.parquet(path)
    return spark.read.parquet(path)


def test_all_rolling_features_share_one_exchange_and_sort(stored):
    for df in (curated.ml_features(stored, AS_OF), mart.user_analytics(stored, AS_OF)):
        text = plan(df)
        assert exchanges(df) == 1
        assert len(re.findall(r"\bWindow \[", text)) == 1 and text.count("Sort [") == 1


def test_business_metrics_shuffles_user_days_once(stored):
    # users, days, and the one-row-per-day global window; no distinct, no rejoin
    df = mart.business_metrics(stored, AS_OF)
    assert exchanges(df) == 3
    assert "Expand" not in plan(df) and "Join" not in plan(df)


def test_columns_are_pruned_at_the_scan(stored):
    read = re.search(r"FileScan parquet \[(.*?)\]", plan(mart.business_metrics(stored, AS_OF))).group(1)
    assert "page_views" not in read and "session" not in read and "total_revenue" in read
    dau = plan(views.daily_active_users(staging.stg_events(star.raw_events(stored.sparkSession, SF), AS_OF)))
    assert "from_json" not in dau  # nothing needs the payload


def test_lookup_filters_reach_the_scan(spark, tmp_path):
    events = staging.stg_events(star.raw_events(spark, SF), AS_OF)
    events.write.partitionBy("event_date").parquet(str(tmp_path / "e"))
    text = plan(views.user_daily_lookup(spark.read.parquet(str(tmp_path / "e")), "1", AS_OF))
    assert "EqualTo(user_id,1)" in text and "EqualTo(is_valid,true)" in text
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_daily_aggregates_add_no_exchange_for_their_join(spark, tmp_path):
    staging.stg_events(star.raw_events(spark, SF), AS_OF).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (curated.daily_user_activity(events), curated.daily_event_type_activity(events)):
            text = plan(df)
            # plain aggregates: one; distinct counts: one over the values, one over the days
            assert exchanges(df) == 3 and "SortMergeJoin" in text
            assert "Expand" in text and "collect_set" not in text and "gid" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_in_any_batch_plan(spark):
    for name in ("user_metrics", "ml_features", "business_metrics", "conversion_funnel", "stg_users"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text


def test_error_lists_are_generated_code(spark):
    """A lambda is interpreted row by row; staging must need none for its error lists."""
    raw = star.with_gaps(star.raw_events(spark, SF))
    for df in (staging.stg_events(raw, AS_OF), staging.stg_users(star.raw_users(spark, SF), AS_OF)):
        errors = df.select("is_valid", "validation_errors")
        assert "lambda" not in plan(errors)
        assert not errors.schema["validation_errors"].dataType.containsNull
        # Valid rows have an empty list, the others say why; no empty label is left in any.
        assert errors.where("is_valid != (size(validation_errors) = 0) OR array_contains(validation_errors, '')").isEmpty()
        assert not errors.where("NOT is_valid").isEmpty()


def test_partitioned_writes_are_rebalanced(spark):
    text = plan(spread(star.raw_events(spark, SF), "event_date", ("user_id",)))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    assert re.search(r"Sort \[event_date#\d+ ASC NULLS FIRST, user_id", text)


def test_hot_user_gives_the_same_numbers(spark):
    """A third of all events on one user: distinct counts and funnel stay exact."""
    raw = star.raw_events(spark, SF).withColumn(
        "user_id", F.when(F.crc32("event_id") % 3 == 0, "hot").otherwise(F.col("user_id"))
    )
    events = staging.stg_events(raw, AS_OF)
    got = {r.date: r for r in curated.daily_user_activity(events).where("user_id = 'hot'").collect()}
    local = events.where("user_id = 'hot' AND is_valid").select("event_date", "session_id", "category", "event_type").collect()
    for day, r in got.items():
        mine = [e for e in local if e.event_date == day]
        assert r.total_events == len(mine)
        assert r.unique_sessions == len({e.session_id for e in mine} - {None})
        assert r.unique_categories_viewed == len({e.category for e in mine} - {None})
    funnel = conversion_funnel(events, FUNNEL, "2024-01-01", "2024-01-30")
    assert rows_of(funnel.where("step = 1"), "users") == [
        (events.where("is_valid AND event_type = 'page_view'").select("user_id").distinct().count(),)
    ]
