"""Day-by-day runs end with the same tables as one full refresh."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from eventloom.plans import carried, curated, daily, incremental, mart, staging
from eventloom.sources import paths
from eventloom.sources import star_schema as star
from eventloom.sources.lake import Lake
from tests.conftest import SF, rows_of

AS_OF = "2024-01-31 00:00:00"
LATER = "2024-02-03 06:00:00"
MODELS = (
    "stg_events", "stg_users", "user_metrics", "event_metrics", "ml_features", "user_analytics", "business_metrics",
)


def settled(df):
    keep = [c for c in df.columns if c not in ("processed_at", "last_updated", "validation_errors")]
    return rows_of(df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.select(*keep).dtypes]))


def test_daily_runs_equal_full_refresh(spark, lake):
    raw, users = star.raw_events(spark, SF), star.raw_users(spark, SF)
    lake.replace("users", users)
    # The first slice holds most days, the other two cross the week boundary on the 28th.
    raw = raw.where("event_date <= DATE'2024-01-28'")
    days = [dt.date(2024, 1, d) for d in (27, 28)]
    lake.replace("events", raw.where(F.col("event_date") < F.lit(days[0])))
    daily.run_models(lake, AS_OF, enforce=())
    for day in days:
        daily.run_day(lake, raw, day, AS_OF, enforce=())

    events, people = staging.stg_events(raw, AS_OF), staging.stg_users(users, AS_OF)
    metrics = curated.user_metrics(events, people, AS_OF)
    full = {
        "stg_events": events,
        "stg_users": people,
        "user_metrics": metrics,
        "event_metrics": curated.event_metrics(events, AS_OF),
        "ml_features": curated.ml_features(metrics, AS_OF),
        "user_analytics": mart.user_analytics(metrics, AS_OF),
        "business_metrics": mart.business_metrics(metrics, AS_OF),
    }
    for name in MODELS:
        assert settled(lake.read(name)) == settled(full[name]), name


def test_rerun_changes_nothing(spark, lake):
    raw = star.raw_events(spark, SF)
    lake.replace("users", star.raw_users(spark, SF))
    lake.replace("events", raw)
    daily.run_models(lake, AS_OF, enforce=())
    before = {n: settled(lake.read(n)) for n in MODELS}
    daily.run_models(lake, AS_OF, enforce=())
    assert {n: settled(lake.read(n)) for n in MODELS} == before


def full_refresh(events, people):
    metrics = curated.user_metrics(events, people, AS_OF)
    return {
        "stg_events": events,
        "user_metrics": metrics,
        "event_metrics": curated.event_metrics(events, AS_OF),
        "ml_features": curated.ml_features(metrics, AS_OF),
        "user_analytics": mart.user_analytics(metrics, AS_OF),
        "business_metrics": mart.business_metrics(metrics, AS_OF),
    }


def test_late_moved_and_undated_rows_and_stopped_runs_end_as_a_full_refresh(spark, lake):
    raw, users = star.raw_events(spark, SF).where("event_date BETWEEN DATE'2024-01-18' AND DATE'2024-01-26'"), star.raw_users(spark, SF)
    number = F.col("event_id").cast("long")
    undated = number % 23 == 5
    raw = raw.withColumns({"event_timestamp": F.when(~undated, F.col("event_timestamp")), "event_date": F.when(~undated, F.col("event_date"))})
    raw = raw.withColumn("event_id", F.when(number % 29 != 3, F.col("event_id"))).cache()
    late = raw.where("event_date = DATE'2024-01-20' AND user_id IN ('1', '2', '3')")
    later = F.col("event_timestamp") + F.expr("INTERVAL 3 DAY")
    moved = raw.where("event_date = DATE'2024-01-21' AND user_id < '5' AND event_id IS NOT NULL").withColumns(
        {"event_timestamp": later, "event_date": F.to_date(later), "created_at": F.col("created_at") + F.expr("INTERVAL 9 DAY")}
    )
    lake.replace("users", users)
    lake.replace("events", raw.where("event_date < DATE'2024-01-25'").exceptAll(late))
    daily.run_models(lake, AS_OF, enforce=())
    for day in (dt.date(2024, 1, 25), dt.date(2024, 1, 26)):
        with pytest.raises(daily.GateFailed):  # the source's own type names are not accepted
            daily.run_day(lake, raw, day, AS_OF)
    lake.upsert("events", late)
    lake.upsert("events", moved)
    lake.upsert("events", late)
    daily.run_models(lake, AS_OF, enforce=())

    gone = moved.select("event_id")
    final = raw.where(F.col("event_id").isNull()).unionByName(raw.join(gone, "event_id", "left_anti").where("event_id IS NOT NULL")).unionByName(moved)
    full = full_refresh(staging.stg_events(final, AS_OF), staging.stg_users(users, AS_OF))
    for name, df in full.items():
        assert settled(lake.read(name)) == settled(df), name
    assert dt.date(2024, 1, 25) in lake.partitions("user_metrics")


def test_late_undated_and_changed_users_end_as_a_full_refresh(spark, lake):
    raw = star.raw_events(spark, SF).where("event_date BETWEEN DATE'2024-01-22' AND DATE'2024-01-26'").cache()
    number = F.pmod(F.xxhash64("user_id"), F.lit(6))
    undated, silent = number == 1, number <= 2  # silent: nothing says when they were updated
    users = star.raw_users(spark, SF).withColumns({
        "created_at": F.when(~undated, F.col("created_at")),
        "user_date": F.when(~undated, F.col("user_date")),
        "updated_at": F.when(~silent, F.col("updated_at")),
    }).cache()
    lake.replace("users", users.where(number > 1).withColumn("country", F.when(number != 2, F.col("country"))))
    lake.replace("events", raw.where("event_date < DATE'2024-01-26'"))
    daily.run_models(lake, AS_OF, enforce=())
    lake.upsert("users", users.where(silent))
    daily.run_day(lake, raw, dt.date(2024, 1, 26), AS_OF, enforce=())
    people = staging.stg_users(users, AS_OF)
    for name, df in {**full_refresh(staging.stg_events(raw, AS_OF), people), "stg_users": people}.items():
        assert settled(lake.read(name)) == settled(df), name


def test_crash_between_models_is_caught_up(spark, lake, monkeypatch):
    raw, users = star.raw_events(spark, SF).where("event_date >= DATE'2024-01-25'"), star.raw_users(spark, SF)
    lake.replace("users", users)
    lake.replace("events", raw.where("event_date < DATE'2024-01-28'"))
    daily.run_models(lake, AS_OF, enforce=())
    features = curated.ml_features
    monkeypatch.setattr(curated, "ml_features", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run_day(lake, raw, dt.date(2024, 1, 28), AS_OF, enforce=())
    monkeypatch.setattr(curated, "ml_features", features)
    daily.run_day(lake, raw, dt.date(2024, 1, 29), AS_OF, enforce=(), training=True, expire_on=dt.date(2024, 1, 31))
    final = raw.where("event_date <= DATE'2024-01-29'")
    for name, df in full_refresh(staging.stg_events(final, AS_OF), staging.stg_users(users, AS_OF)).items():
        assert settled(lake.read(name)) == settled(df), name
    assert lake.read("ml_training").count() == lake.read("ml_features").count()


def test_gate_stops_the_run(spark, lake):
    lake.replace("users", star.raw_users(spark, SF))
    lake.replace("events", star.raw_events(spark, SF))
    with pytest.raises(daily.GateFailed, match="accepted_values"):
        daily.run_models(lake, AS_OF)
    assert not lake.exists("user_metrics")


@pytest.mark.parametrize("since", [dt.date(2024, 1, d) for d in (1, 7, 8, 31)] + [dt.date(2024, 2, d) for d in (1, 3, 4)])
def test_business_slice_equals_full(spark, since):
    """Any cut, around month and week boundaries, with days missing."""
    start = dt.date(2023, 11, 20)
    rows = [
        (str(u), start + dt.timedelta(days=d))
        for d in range(80)
        for u in range(6)
        if (d * 7 + u * 5) % 11 < 4 and d % 9 != 0
    ]
    metrics = (
        spark.createDataFrame(rows, "user_id string, date date")
        .withColumns({
            "country": F.lit("US"), "user_tier": F.lit("basic"), "days_since_registration": F.lit(3),
            "total_events": F.lit(2), "total_purchases": F.lit(1), "total_revenue": F.dayofmonth("date") * 1.5,
        })
    )
    days = sorted({d for _, d in rows})
    part = incremental.slice_business_metrics(metrics, since, days, AS_OF)
    _, emit = incremental.business_bounds(since, days)
    full = mart.business_metrics(metrics, AS_OF).where(F.col("date") >= F.lit(emit))
    assert settled(part) == settled(full)


# --- moving run times, changed users, carried state ---------------------------------------------


def presented_like_full(lake, events, people, as_of):
    metrics = curated.user_metrics(events, people, as_of)
    full = {
        "stg_events": events,
        "stg_users": people,
        "user_metrics": metrics,
        "event_metrics": curated.event_metrics(events, as_of),
        "ml_features": curated.ml_features(metrics, as_of),
        "user_analytics": mart.user_analytics(metrics, as_of),
        "business_metrics": mart.business_metrics(metrics, as_of),
    }
    for name, df in full.items():
        assert settled(daily.read(lake, name, as_of)) == settled(df), name


def test_moving_run_time_retries_and_changed_users_end_as_a_full_refresh(spark, lake):
    raw = star.raw_events(spark, SF).where("event_date BETWEEN DATE'2024-01-17' AND DATE'2024-01-26'").cache()
    users = star.raw_users(spark, SF).cache()
    number = F.pmod(F.xxhash64("user_id"), F.lit(5))
    late = raw.where("event_date = DATE'2024-01-20' AND user_id IN ('1', '2', '3')")
    lake.replace("users", users.where(number != 0).withColumn("country", F.when(number != 1, F.col("country"))))
    lake.replace("events", raw.where("event_date < DATE'2024-01-24'").exceptAll(late))
    daily.run_models(lake, "2024-01-24 06:00:00", enforce=())
    daily.run_day(lake, raw, dt.date(2024, 1, 24), "2024-01-25 06:00:00", enforce=())
    # Changed and new users; then late rows of two days, one of which is loaded again afterwards.
    lake.upsert("users", users.where(number <= 1))
    daily.run_day(lake, raw.exceptAll(raw.where("event_date = DATE'2024-01-25' AND user_id IN ('4', '5')")), dt.date(2024, 1, 25), "2024-01-26 06:00:00", enforce=())
    lake.upsert("events", late.unionByName(raw.where("event_date = DATE'2024-01-25' AND user_id IN ('4', '5')")))
    lake.append_day("events", raw, dt.date(2024, 1, 25))
    daily.run_models(lake, "2024-01-26 18:00:00", enforce=())
    daily.run_day(lake, raw, dt.date(2024, 1, 26), "2024-02-03 06:00:00", enforce=())
    as_of = "2024-02-05 12:00:00"
    presented_like_full(lake, staging.stg_events(raw, as_of), staging.stg_users(users, as_of), as_of)


def test_withdrawn_rows_leave_the_features(spark, lake):
    """A delivery loaded again without some users' rows: their days go, their later windows shrink."""
    raw = star.raw_events(spark, SF).where("event_date BETWEEN DATE'2024-01-20' AND DATE'2024-01-24'").cache()
    users = star.raw_users(spark, SF)
    lake.replace("users", users)
    lake.replace("events", raw.where("event_date < DATE'2024-01-22'"))
    daily.run_models(lake, AS_OF, enforce=())
    for day in (22, 23, 24):
        daily.run_day(lake, raw, dt.date(2024, 1, day), AS_OF, enforce=())
    left = raw.where("NOT (event_date = DATE'2024-01-22' AND user_id < '4')")
    daily.run_day(lake, left, dt.date(2024, 1, 22), AS_OF, enforce=())
    for name, df in full_refresh(staging.stg_events(left, AS_OF), staging.stg_users(users, AS_OF)).items():
        assert settled(lake.read(name)) == settled(df), name


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def loaded(spark, lake):
    raw = star.raw_events(spark, SF).where("event_date BETWEEN DATE'2024-01-20' AND DATE'2024-01-24'")
    lake.replace("users", star.raw_users(spark, SF))
    lake.replace("events", raw.where("event_date < DATE'2024-01-24'"))
    daily.run_models(lake, AS_OF, enforce=())
    return lake, raw


def test_new_day_reads_the_state_and_the_day(loaded):
    lake, raw = loaded
    state = carried.CarriedState(lake)
    assert state.upto == dt.date(2024, 1, 23)
    day = dt.date(2024, 1, 24)
    lake.append_day("events", raw, day)
    events = lake.read("events").where(F.col("event_date") == F.lit(day))
    new = curated.user_metrics(staging.stg_events(events, AS_OF), lake.read("stg_users"), AS_OF)
    lake.replace_dates("user_metrics", new, touched={day})
    part = carried.Slice(state, lake.read("user_metrics"), {day}, True)
    fresh, late = part.rows(lambda rows: curated.ml_features(rows, AS_OF), "feature_date")
    assert late is None
    text = plan_of(fresh)
    scans = re.findall(r"FileScan parquet \[(.*?)\].*?PartitionFilters: \[(.*?)\], PushedFilters", text)
    metrics = [filters for columns, filters in scans if "date#" in columns]
    state_scans = [columns for columns, _ in scans if "rows#" in columns]
    assert metrics and all(re.search(r"date#\d+ > 2024-01-23", f) for f in metrics)
    assert state_scans and len(scans) == len(metrics) + len(state_scans)


def test_changed_user_is_patched_without_events(spark, loaded, monkeypatch):
    lake, _ = loaded
    read, seen = lake.read, []
    monkeypatch.setattr(lake, "read", lambda name: seen.append(name) or read(name))
    before = {f for d in paths.children(spark, lake.path("user_metrics")) if "=" in d for f in paths.files(spark, f"{lake.path('user_metrics')}/{d}")}
    one = star.raw_users(spark, SF).where("user_id = (SELECT min(user_id) FROM VALUES ('1') AS t(user_id))").withColumn("country", F.lit("xx"))
    lake.upsert("users", one)
    seen.clear()
    daily._stage_users(lake, AS_OF)
    assert "stg_events" not in seen and "events" not in seen
    for name in ("user_metrics", "ml_features", "user_analytics"):
        countries = {(r.user_id == "1", r.country == "XX") for r in read(name).select("user_id", "country").collect()}
        assert countries == {(True, True), (False, False)}, name
    assert lake.pending("ml_features") == set() and lake.pending("business_metrics")
    after = {f for d in paths.children(spark, lake.path("user_metrics")) if "=" in d for f in paths.files(spark, f"{lake.path('user_metrics')}/{d}")}
    assert before - after and len(before - after) <= len({r[0] for r in read("user_metrics").where("user_id = '1'").select("date").collect()})


def test_changed_users_are_patched_by_one_write_of_the_files(spark, loaded, monkeypatch):
    """No upsert of patched rows; other users in the files keep what they say at any run time."""
    lake, _ = loaded
    upserts, upsert = [], lake.upsert
    shown = {n: [r for r in rows_of(daily.read(lake, n, LATER)) if "1" not in r[:1]] for n in ("user_metrics", "ml_features", "user_analytics")}
    some = star.raw_users(spark, SF).where("user_id IN ('1', 'nobody')").withColumn("country", F.lit("xx"))
    lake.upsert("users", some)
    monkeypatch.setattr(lake, "upsert", lambda name, *a, **k: upserts.append(name) or upsert(name, *a, **k))
    daily._stage_users(lake, LATER)
    assert upserts == ["stg_users"]
    for name, before in shown.items():
        assert [r for r in rows_of(daily.read(lake, name, LATER)) if "1" not in r[:1]] == before, name


def test_versions_of_the_state_are_merged(loaded, monkeypatch):
    lake, raw = loaded
    monkeypatch.setattr(carried, "MAX_VERSIONS", 1)
    daily.run_day(lake, raw, dt.date(2024, 1, 24), AS_OF, enforce=())
    state = carried.CarriedState(lake)
    want = carried.state_of(carried.with_ever(lake.read("user_metrics"))).withColumn("_ever_revenue", F.round("_ever_revenue", 6))
    got = state.read().withColumn("_ever_revenue", F.round("_ever_revenue", 6)).select(want.columns)
    assert state.upto == dt.date(2024, 1, 24) and rows_of(got) == rows_of(want)
