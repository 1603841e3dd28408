"""Streams over several files: replays, late copies and what stays withheld."""

import datetime as dt

import pytest

from eventloom.operators.sessions import activity, sessions_by_gap
from eventloom.plans import staging
from eventloom.sources import schemas
from eventloom.streaming import jobs
from eventloom.streaming import partials as live
from tests.conftest import AS_OF, make_events, rows_of


@pytest.fixture
def inbox(spark, tmp_path):
    """Write files one by one; read them as a stream, one file per micro-batch."""
    folder = tmp_path / "inbox"

    class Inbox:
        n = 0

        def drop(self, *rows):
            self.n += 1
            events = [dict(event_id=i, user_id=u, event_type=k, event_timestamp=at, created_at=at) for i, u, k, at in rows]
            make_events(spark, events).drop("event_date").coalesce(1).write.mode("append").parquet(str(folder))

        def stream(self):
            source = spark.readStream.schema(schemas.EVENTS).option("maxFilesPerTrigger", 1).parquet(str(folder))
            from eventloom.sources.readers import with_date

            return with_date(source, "event_timestamp", "event_date")

    return Inbox()


def test_staging_upserts_across_batches_and_restarts(spark, lake, inbox, tmp_path):
    check = str(tmp_path / "check")
    inbox.drop(("a", "u", "click", "2025-01-01 10:00:00"), ("b", "u", "click", "2025-01-01 11:00:00"))
    inbox.drop(("a", "u", "login", "2025-01-02 10:00:00"))
    jobs.stage_into(lake, inbox.stream(), check, AS_OF).awaitTermination()
    inbox.drop(("c", "", "click", "2025-01-02 12:00:00"))
    jobs.stage_into(lake, inbox.stream(), check, AS_OF).awaitTermination()
    got = rows_of(lake.read("stg_events"), "event_id", "event_type", "is_valid")
    assert got == [("a", "login", True), ("b", "click", True), ("c", "click", False)]


def test_dedup_drops_copies_within_the_delay(inbox, spark, tmp_path):
    inbox.drop(("a", "u", "click", "2025-01-01 10:00:00"), ("a", "u", "click", "2025-01-01 10:10:00"))
    inbox.drop(("a", "u", "click", "2025-01-01 10:20:00"), ("b", "u", "click", "2025-01-01 10:30:00"))
    out = jobs.run_to_table(jobs.deduplicated(inbox.stream()), str(tmp_path / "out"), str(tmp_path / "check"))
    assert [r.event_id for r in out.orderBy("event_id").collect()] == ["a", "b"]


def test_daily_metrics_emit_closed_days_with_exact_users(inbox, spark, tmp_path):
    inbox.drop(("1", "u", "click", "2025-01-01 10:00:00"), ("2", "u", "click", "2025-01-01 11:00:00"))
    inbox.drop(("3", "v", "click", "2025-01-01 10:30:00"))
    inbox.drop(("4", "v", "click", "2025-01-02 02:00:00"))
    staged = staging.stg_events(inbox.stream(), AS_OF)
    out = jobs.run_to_table(jobs.daily_type_metrics(staged), str(tmp_path / "out"), str(tmp_path / "check"))
    assert [(str(r.date), r.total_events, r.unique_users) for r in out.collect()] == [("2025-01-01", 3, 2)]


def test_sessions_close_after_the_gap(inbox, spark, tmp_path):
    inbox.drop(("1", "u", "click", "2025-01-01 10:00:00"), ("2", "u", "page_view", "2025-01-01 10:29:00"))
    inbox.drop(("3", "u", "click", "2025-01-01 11:00:00"), ("4", "u", "click", "2025-01-01 15:00:00"))
    staged = staging.stg_events(inbox.stream(), AS_OF)
    out = jobs.run_to_table(jobs.user_sessions(staged), str(tmp_path / "out"), str(tmp_path / "check"))
    got = rows_of(out, "events_count", "page_views", "started_at")
    assert [(n, p, str(t)) for n, p, t in got] == [(1, 0, "2025-01-01 11:00:00"), (2, 1, "2025-01-01 10:00:00")]


def staged_rows(spark, n, users, seed):
    import random

    rnd = random.Random(seed)
    base = 1_735_689_600  # 2025-01-01
    rows = []
    for i in range(n):
        at = base + rnd.choice([0, 1800, 3600, 5400]) * rnd.randrange(0, 30) + rnd.choice([0, 0, 1, 60, 1799])
        rows.append((f"e{i}", rnd.choice(users), rnd.choice(["click", "page_view", "purchase"]), dt.datetime.fromtimestamp(at, dt.timezone.utc).replace(tzinfo=None)))
    return rows


def gap_sessions(rows, gap=1800):
    out = []
    for user in sorted({u for _, u, _, _ in rows}):
        mine = sorted((t, k) for _, u, k, t in rows if u == user)
        held = [mine[0]]
        for one in mine[1:] + [None]:
            if one is None or (one[0] - held[-1][0]).total_seconds() > gap:
                out.append((user, len(held), sum(k == "page_view" for _, k in held), held[0][0], held[-1][0]))
                held = []
            held.append(one)
    return sorted(out)


def test_sessions_in_two_levels_equal_a_walk(spark):
    rows = staged_rows(spark, 600, ["hot"] * 8 + ["a", "b", "c"], 1)
    df = spark.createDataFrame(rows, "event_id string, user_id string, event_type string, event_timestamp timestamp")
    got = rows_of(sessions_by_gap(df), "user_id", "events_count", "page_views", "started_at", "ended_at")
    assert sorted(got) == gap_sessions(rows)
    assert sessions_by_gap(df.limit(0)).count() == 0


def test_hot_user_is_combined_before_the_exchange(spark):
    df = spark.range(100_000).selectExpr("CAST(id AS STRING) AS event_id", "'hot' AS user_id", "'click' AS event_type", "timestamp_seconds(1735689600 + id) AS event_timestamp")
    df = df.repartition(8)
    assert rows_of(sessions_by_gap(df), "events_count") == [(100_000,)]
    stretches = activity(df)
    assert stretches.count() == 56  # all that is sorted for the user, however many events there are
    plan = stretches._jdf.queryExecution().executedPlan().toString()
    # Printed from the top: the final count, the exchange by user and stretch, the partial count below it.
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(") and "Window" not in plan


def test_live_tables_hold_open_windows_and_survive_replays(spark, inbox, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "MAX_BATCHES", 2)
    batches = [
        [("1", "u", "click", "2025-01-01 10:00:00"), ("2", "u", "page_view", "2025-01-01 10:29:00")],
        [("3", "v", "click", "2025-01-01 10:30:00")],
        [("4", "u", "click", "2025-01-01 10:45:00"), ("5", "v", "click", "2025-01-02 02:00:00")],
        [("6", "u", "click", "2025-01-01 09:40:00"), ("7", "u", "click", "2025-01-01 12:00:00")],  # late by hours
        [("8", "w", "click", "2025-01-01 23:59:00"), ("9", "w", "click", "2025-01-02 00:10:00")],
    ]
    parts = [live.type_users(spark, str(tmp_path / "types")), live.user_activity(spark, str(tmp_path / "users"))]
    for n, rows in enumerate(batches):
        inbox.drop(*rows)
        staged = staging.stg_events(inbox.stream(), AS_OF)
        for i, p in enumerate(parts):
            p.run(staged, str(tmp_path / f"check{i}")).awaitTermination()
        again = make_events(spark, [dict(event_id=i, user_id=u, event_type=k, event_timestamp=at, created_at=at) for i, u, k, at in rows])
        for p in parts:
            p.land(staging.stg_events(again, AS_OF), n)  # the batch is delivered again, merged by now or not
    got = rows_of(live.daily_type_metrics(parts[0]), "event_type", "date", "total_events", "unique_users")
    assert [(k, str(d), n, u) for k, d, n, u in got] == [("click", "2025-01-01", 6, 3), ("click", "2025-01-02", 2, 2), ("page_view", "2025-01-01", 1, 1)]
    sessions = [(u, n, str(a), str(b)) for u, n, a, b in rows_of(live.user_sessions(parts[1]), "user_id", "events_count", "started_at", "ended_at")]
    assert sessions == [
        ("u", 1, "2025-01-01 12:00:00", "2025-01-01 12:00:00"), ("u", 4, "2025-01-01 09:40:00", "2025-01-01 10:45:00"),
        ("v", 1, "2025-01-01 10:30:00", "2025-01-01 10:30:00"), ("v", 1, "2025-01-02 02:00:00", "2025-01-02 02:00:00"),
        ("w", 2, "2025-01-01 23:59:00", "2025-01-02 00:10:00"),
    ]
    assert parts[0]._meta()["upto"] >= 2
