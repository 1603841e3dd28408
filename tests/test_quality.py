import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from eventloom.checks import queries
from eventloom.sources.lake import Lake
from eventloom.operators import quality as q
from eventloom.operators.funnel import conversion_funnel
from eventloom.plans import assertions, quality_report as report, staging
from eventloom.sources.catalog import TABLES
from tests.conftest import AS_OF, SF, make_events, make_users, rows_of


def test_starter_models(spark, tmp_path):
    """A table with ids 1 and NULL, and a second model of its non-NULL rows."""
    first = spark.createDataFrame([(1,), (None,)], "id int")
    first.write.mode("overwrite").parquet(str(tmp_path / "first"))
    second = spark.read.parquet(str(tmp_path / "first")).where("id = 1")
    assert rows_of(q.unique_not_null(first, "id")) == [("id", "not_null", 1), ("id", "unique", 0)]
    assert rows_of(q.unique_not_null(second, "id")) == [("id", "not_null", 0), ("id", "unique", 0)]


def test_duplicates_with_nulls_are_counted(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (2, "x"), (3, "y")], "a int, b string")
    assert rows_of(q.duplicate_rows(rows, "t")) == [("t", 6, 3, 3)]
    assert rows_of(q.duplicate_rows(rows.where("a > 9"), "t")) == [("t", 0, 0, 0)]


def test_null_passes_value_checks(spark):
    rows = spark.createDataFrame([("a",), (None,), ("z",), ("z",)], "v string")
    assert rows_of(q.accepted_values(rows, "v", ["a"])) == [("v", "z", 2)]
    assert rows_of(q.expressions_true(rows, {"v is a": F.col("v") == "a"})) == [("v is a", 2)]
    assert rows_of(q.not_null_proportion(rows, ["v"], 0.75)) == [("v", 0.75, True)]
    assert rows_of(q.not_null_proportion(rows, ["v"], 0.76)) == [("v", 0.75, False)]


@pytest.mark.parametrize("latest, status", [("2025-01-15 20:00:01", "success"), ("2025-01-15 18:59:59", "warning"), (None, "error")])
def test_freshness(spark, latest, status):
    rows = spark.createDataFrame([(latest,)], "at string").select(F.col("at").cast("timestamp").alias("at"))
    assert q.freshness(rows, "t", "at", AS_OF).first().status == status


def test_anomaly_against_previous_rows(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), i) for d in range(9) for i in range(100 if d == 8 else 10 + d % 2)]
    got = q.volume_anomalies(spark.createDataFrame(days, "day date, i int"), "day").orderBy("date").collect()
    assert [r.is_anomaly for r in got] == [False] * 8 + [True]
    assert got[0].z_score is None


def test_anomaly_after_steady_days_and_on_a_missing_day(spark):
    start = dt.date(2024, 1, 1)
    counts = [10] * 8 + [1000] + [10] * 8 + [0] + [10]
    days = [(start + dt.timedelta(days=d), i) for d, n in enumerate(counts) for i in range(n)] + [(None, 1)]
    got = q.volume_anomalies(spark.createDataFrame(days, "day date, i int"), "day").orderBy("date").collect()
    assert [r.n_rows for r in got] == counts
    assert [d for d, r in enumerate(got) if r.is_anomaly] == [8, 17]
    assert q.volume_anomalies(spark.createDataFrame([], "day date"), "day").count() == 0


def test_schema_changes(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    new = spark.createDataFrame([(1, 2.0)], "a long, c double")
    got = set(rows_of(q.schema_changes(old, new)))
    assert got == {
        ("*", "same_rows", "1", "1"), ("a", "retyped", "int", "bigint"),
        ("b", "removed", "string", None), ("c", "added", None, "double"),
    }


def test_assertion_count_and_a_failing_model(spark):
    kinds = [
        (1, len(a.present), len(a.accepted), len(a.conditions(AS_OF))) for a in assertions.MODELS.values()
    ]
    assert tuple(map(sum, zip(*kinds))) == (7, 16, 4, 57)
    rows = [dict(event_id="e", user_id="u", event_type=k, event_timestamp="2025-01-15 00:00:00", platform="ios",
                 metadata='{"amount": -1}') for k in ("click", "tap")]
    found = assertions.check_model(staging.stg_events(make_events(spark, rows), AS_OF), "stg_events", AS_OF)
    failed = {(r.check_type, r.target): r.failed_rows for r in found.where("NOT passed").collect()}
    assert failed == {
        ("accepted_values", "event_type"): 1, ("accepted_values", "platform"): 2,
        ("expression_is_true", "amount is null or amount >= 0"): 2,
        ("unique_combination", "event_id, event_timestamp"): 1,
    }


def test_quality_checks_see_duplicates_and_nulls(spark):
    rows = [dict(event_id=i, user_id="u", event_type="tap", event_timestamp="2025-01-17 00:00:00", metadata='{"amount": -1}')
            for i in ("a", "a", None)]
    events = staging.stg_events(make_events(spark, rows), AS_OF)
    users = staging.stg_users(make_users(spark, [dict(user_id="u", email="bad", created_at="2025-02-01 00:00:00")] * 2), AS_OF)
    from eventloom.plans import curated, mart

    metrics = curated.user_metrics(events, users, AS_OF)
    tables = {"stg_events": events, "stg_users": users, "user_metrics": metrics,
              "business_metrics": mart.business_metrics(metrics, AS_OF), "ml_features": curated.ml_features(metrics, AS_OF)}
    found = report.quality_checks(tables, AS_OF)
    got = {(r.model_name, r.test_name): r.failed_rows for r in found.collect()}
    assert len(got) == 18
    assert {k: v for k, v in got.items() if v} == {
        ("stg_events", "null_event_ids"): 1, ("stg_events", "invalid_event_types"): 3,
        ("stg_events", "negative_amounts"): 3, ("stg_events", "future_event_timestamps"): 3,
        ("stg_events", "duplicate_event_ids"): 2,  # count(*) - count(distinct): the NULL id counts too
        ("stg_users", "invalid_emails"): 2, ("stg_users", "future_created_at"): 2, ("stg_users", "duplicate_user_ids"): 1,
    }


STEPS = ("page_view", "click", "signup", "purchase")


def furthest(events):
    """Brute force: walk one user's events in time order."""
    reached, last = 0, None
    while reached < len(STEPS):
        times = [t for t, k in events if k == STEPS[reached] and (last is None or t >= last)]
        if not times:
            break
        reached, last = reached + 1, min(times)
    return reached


@pytest.mark.parametrize("seed", range(3))
def test_funnel_against_brute_force(spark, seed):
    rng = random.Random(seed)
    start = dt.datetime(2025, 1, 1)
    rows, by_user = [], {}
    for i in range(400):
        user, kind = f"u{rng.randrange(60)}", rng.choice(STEPS + ("error",))
        # whole minutes, so equal times across steps occur
        at = start + dt.timedelta(minutes=rng.randrange(60 * 30))
        by_user.setdefault(user, []).append((at, kind))
        rows.append(dict(event_id=str(i), user_id=user, event_type=kind, event_timestamp=str(at)))
    events = staging.stg_events(make_events(spark, rows), AS_OF)
    want = [sum(furthest(e) >= s for e in by_user.values()) for s in range(1, 5)]
    for bucket in ("HOUR", "DAY", "MINUTE"):
        got = conversion_funnel(events, STEPS, "2025-01-01", "2025-01-31", bucket=bucket).orderBy("step")
        assert [r.users for r in got.collect()] == want


def test_every_model_is_a_known_table():
    assert set(assertions.MODELS) <= set(TABLES)


def test_duplicates_shuffle_hashes_and_tell_collisions_from_copies(spark, monkeypatch):
    rows = spark.createDataFrame([(1, None, 0.0), (1, None, -0.0), (None, 1, 0.0), (2, 2, 1.0), (2, 2, 1.0), (3, 3, float("nan")), (3, 3, float("nan"))], "a int, b int, c double")
    assert rows_of(q.duplicate_rows(rows, "t")) == [("t", 7, 4, 3)]
    # Every row in one hash group: still counted by content.
    monkeypatch.setattr(q.F, "xxhash64", lambda *a: q.F.lit(1))
    assert rows_of(q.duplicate_rows(rows, "t")) == [("t", 7, 4, 3)]
    monkeypatch.undo()
    plan = q.duplicate_rows(rows, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_hash1") > 4


def test_reports_of_stored_tables_read_the_newest_partitions(spark):
    lake = queries._stored(spark, SF, ["events", *report.FRESHNESS])
    for df in (report.lake_slas(lake, queries.AS_OF), report.lake_report(lake, queries.AS_OF)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
        assert scans and all("(" in s or "=" in s for s in scans), scans  # each scan is bounded
    assert rows_of(report.lake_slas(lake, queries.AS_OF)) == rows_of(report.layer_slas({k: (t, lake.read(t), c) for k, (t, c) in report.LAYERS.items()}, queries.AS_OF))


def test_reports_store_each_table_once(spark, monkeypatch):
    written, replace = [], Lake.replace
    monkeypatch.setattr(Lake, "replace", lambda lake, name, df: written.append((name, " ".join(df.inputFiles()))) or replace(lake, name, df))
    monkeypatch.setattr(Lake, "materialise", lambda *a: 1 / 0)
    lake = queries._stored(spark, SF, report.FRESHNESS)
    assert sorted(n for n, _ in written) == sorted(report.FRESHNESS)
    sources = dict(written)
    assert "/stg_events/" in sources["user_metrics"] and "/stg_events/" in sources["event_metrics"] and "/user_metrics/" in sources["business_metrics"]
    assert not lake.index("stg_events").exists()  # nothing is upserted
    monkeypatch.undo()
    assert "/report-" in " ".join(queries.quality_alerts(spark, SF).inputFiles())
