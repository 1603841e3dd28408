"""The daily batch: load, staging, curated, mart, each layer behind its assertions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from functools import reduce

from pyspark import InheritableThread
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.expressions import AsOf
from eventloom.operators.keyed import content_of, has_key, latest_per_key, sync_columns, with_keys_of, without_keys_of
from eventloom.plans import carried, curated, incremental, mart, present, staging
from eventloom.plans.assertions import check_models
from eventloom.plans.views import dag_quality_check
from eventloom.sources.catalog import TABLES
from eventloom.sources.lake import Lake, dates_of, on_dates

ALL_CHECKS = ("unique_combination", "not_null_proportion", "accepted_values", "expression_is_true")


def read(lake: Lake, name: str, as_of: AsOf) -> DataFrame:
    """A stored model as of a run time: the ages that its rows carry follow the run."""
    registered = lake.read("user_registrations") if name == "business_metrics" else None
    return present.presented(name, lake.read(name), as_of, registered)


class GateFailed(RuntimeError):
    """A layer broke assertions that the run enforces."""


def gate(lake: Lake, names: Collection[str], as_of: AsOf, enforce: Collection[str], since: dt.date | None = None) -> None:
    """Raise when a table breaks its assertions.

    A table in date partitions is checked from ``since`` on, and where there is no date: older days
    passed before, and scanning all history every day would cost more than the models.
    """

    def checked(name: str) -> DataFrame:
        df, table = lake.read(name), TABLES[name]
        if since is None or not table.needs_filter:
            return df
        return df.where((F.col(table.date_col) >= F.lit(since)) | F.col(table.date_col).isNull())

    found = check_models({n: checked(n) for n in names}, as_of)
    rows = found.where("NOT passed").where(F.col("check_type").isin(*enforce)).collect()  # one per assertion
    if rows:
        raise GateFailed("; ".join(f"{r.model} {r.check_type} [{r.target}]: {r.failed_rows}" for r in rows))


def _stage_events(lake: Lake, as_of: AsOf, search_back_days: int | None) -> None:
    """Stage the raw days that changed, whatever their date: late rows, corrections, rows without one.
    Rows that a delivery took back leave the staged days too."""
    days = lake.pending("stg_events")
    if days is None or days:
        raw = lake.read("events")
        fresh = staging.stg_events(raw if days is None else raw.where(on_dates("event_date", days)), as_of)
        held = set(lake.partitions("stg_events")) if days is not None else set()
        gone = withdrawn = None
        if days is not None and days & held:
            keys, stored = TABLES["stg_events"].keys, lake.read("stg_events").where(on_dates("event_date", days & held))
            gone = without_keys_of(stored.where(has_key(keys)), fresh, keys).select(*keys, "event_date")
            content, synced = list(content_of(fresh)), sync_columns(stored, fresh)
            loose = [x.where(~has_key(keys)).withColumns(content_of(fresh)).select(*content, F.col("event_date").alias("_day"), F.lit(n).alias("_copies")) for x, n in ((synced, 1), (fresh, -1))]
            surplus = loose[0].unionAll(loose[1]).groupBy(*content).agg(F.max("_day").alias("_day"), F.sum("_copies").alias("_copies")).where("_copies > 0")
            surplus = lake.materialise(surplus, "surplus-rows")
            withdrawn = None if surplus.isEmpty() else surplus
        lake.upsert("stg_events", fresh, search_back_days, withdrawn=withdrawn, gone=gone)
        lake.settle("stg_events", days)


def _stage_users(lake: Lake, as_of: AsOf) -> None:
    """Stage the raw users whose partitions changed, without a date too.  The stored rows of users that
    the models see changed are patched before the users are stored, so no crash can lose them."""
    days = lake.pending("stg_users")
    if days is None or days:
        raw = lake.read("users")
        if days is not None:
            keys = TABLES["users"].keys
            changed = raw.where(on_dates("user_date", days))
            # Versions of the same users in other partitions compete too.
            raw = with_keys_of(raw, changed.where(has_key(keys)), keys).unionByName(changed.where(~has_key(keys)))
        staged = staging.stg_users(raw, as_of)
        if lake.exists("user_metrics"):
            _patch_users(lake, lake.materialise(staged, "staged-users"), as_of)
        lake.upsert("stg_users", staged)
        lake.settle("stg_users", days)


CONTEXT = ("country", "user_tier", "_registered")


def _contexts(users: DataFrame) -> DataFrame:
    """What the user days say of their users, without ages: those depend on the run."""
    return curated.user_context(users.withColumn("days_since_registration", present.registered_on("processed_at"))).toDF("user_id", *CONTEXT)


def _patch_users(lake: Lake, staged: DataFrame, as_of: AsOf) -> None:
    """Replace the columns of changed users in all stored user days; no event is read.

    Only users with user days count, and only files that hold such a row are read and written, once
    each.  A user who is not valid any more loses the columns.
    """
    table = TABLES["stg_users"]
    fresh = latest_per_key(staged, table.keys, table.newest_first).where(has_key(table.keys))
    new = lake.materialise(_contexts(fresh), "new-contexts")
    both = new.withColumn("_n", F.lit(1))
    if lake.exists("stg_users"):
        old = _contexts(with_keys_of(sync_columns(lake.read("stg_users"), fresh), fresh, table.keys))
        both = both.unionAll(old.withColumn("_n", F.lit(-1)))
    ids = both.groupBy("user_id", *CONTEXT).agg(F.sum("_n").alias("_n")).where("_n <> 0").select("user_id").distinct()
    active = with_keys_of(ids, lake.read("user_metrics"), ["user_id"])
    changed = lake.materialise(active.join(new, "user_id", "left"), "changed-users")
    if changed.isEmpty():
        return

    change = changed.toDF("user_id", *[f"_new_{c}" for c in CONTEXT]).withColumn("_changed", F.lit(True))

    def patch(name: str, marks: tuple[str, ...]) -> None:
        def changes(rows: DataFrame) -> DataFrame:
            theirs = {
                "country": F.col("_new_country"),
                "user_tier": F.col("_new_user_tier"),
                "days_since_registration": F.datediff(F.to_date("last_updated"), F.col("_new__registered")),
            }
            patched = rows.join(change, "user_id", "left").withColumns({c: F.when(F.col("_changed"), new).otherwise(F.col(c)) for c, new in theirs.items()})
            return present.presented(name, patched.select(rows.columns), as_of)

        lake.patch(name, changed.select("user_id"), changes, marks)

    together(*[
        lambda n=n, m=m: patch(n, m)
        for n, m in (("user_metrics", ("business_metrics", "user_registrations")), ("ml_features", ()), ("user_analytics", ()))
        if lake.exists(n)
    ])


def _stage_sessions(lake: Lake, as_of: AsOf) -> None:
    days = lake.pending("stg_sessions")
    if lake.exists("sessions") and (days is None or days):
        raw = lake.read("sessions")
        fresh = raw if days is None else raw.where(on_dates("session_date", days))
        lake.upsert("stg_sessions", staging.stg_sessions(fresh, as_of))
        lake.settle("stg_sessions", days)


def _oldest(days: Collection[dt.date | None]) -> dt.date | None:
    """The oldest of some first days, where None stands for all days; with nothing to do, no day."""
    return None if None in days else min(days, default=dt.date.max)


def _waiting(lake: Lake, *names: str) -> dt.date | None:
    """The oldest day that some of these models have not taken over yet; None: all of them."""
    pending = [lake.pending(n) for n in names]
    return None if None in pending else _oldest([d for days in pending for d in days if d])


class _Models:
    """The models over one lake; each takes over its own pending days and settles them once stored."""

    def __init__(self, lake: Lake, as_of: AsOf):
        self.lake, self.as_of = lake, as_of
        self.since: list[dt.date | None] = []  # first day stored anew, per model
        self.state = carried.CarriedState(lake)

    def refresh(self, name: str, full: Callable[[], DataFrame], part: Callable[[set], tuple[DataFrame, set, set]]) -> None:
        """``part`` gives the new rows, the days that may be stored anew, and those of them that still have rows."""
        lake, days = self.lake, self.lake.pending(name)
        dated = None if days is None else {d for d in days if d}  # a row without a date is in no model
        if dated is None:
            lake.replace(name, full())
            self.since.append(None)
        elif dated:
            df, scope, live = part(dated)
            lake.replace_dates(name, df, [d for d in lake.partitions(name) if d in scope and d not in live], touched=scope)
            self.since.append(min(scope))
        lake.settle(name, days)

    def user_metrics(self) -> None:
        lake = self.lake
        events, users = lake.read("stg_events"), present.presented("stg_users", lake.read("stg_users"), self.as_of)

        def part(days: set):
            changed = events.where(on_dates("event_date", days))
            rows = curated.user_metrics(changed, users, self.as_of)
            late = {d for d in days if self.state.upto and d <= self.state.upto}
            if late:
                rows = lake.materialise(rows, "user-days")
                old = present.presented("user_metrics", lake.read("user_metrics").where(on_dates("date", late)), self.as_of)
                self.state.note(old, rows.where(on_dates("date", late)))
            return rows, days, dates_of(changed.where("is_valid"), "event_date")

        self.refresh("user_metrics", lambda: curated.user_metrics(events, users, self.as_of), part)

    def event_metrics(self) -> None:
        lake = self.lake
        events = lake.read("stg_events")

        def part(days: set):
            stored = lake.read("event_metrics")  # one row per type and day
            changed = events.where(on_dates("event_date", days))
            live = dates_of(changed.where("is_valid"), "event_date")
            since = min(days)
            scope = days | {d for d in lake.partitions("event_metrics") if d and d >= since}
            return incremental.patch_event_metrics(changed, stored, days, self.as_of), scope, live | (scope - days)

        self.refresh("event_metrics", lambda: curated.event_metrics(events, self.as_of), part)

    def per_user(self, name: str, model: Callable[[DataFrame, AsOf], DataFrame]) -> None:
        """Models of rolling user days: a changed day changes all later rows of its users, of no others."""
        lake, days, day = self.lake, self.lake.pending(name), TABLES[name].date_col
        dated = None if days is None else {d for d in days if d}
        metrics = read(lake, "user_metrics", self.as_of)
        if dated is None:
            lake.replace(name, model(metrics, self.as_of))
            self.since.append(None)
        elif dated:
            part = carried.Slice(self.state, metrics, dated, lake.pending("user_windows") is not None)
            fresh, late = part.rows(lambda rows: model(rows, self.as_of), day)
            if late is not None:
                earlier = (F.col(day) >= F.lit(min(part.late))) & (F.col(day) < F.lit(min(part.new)) if part.new else F.lit(True))
                held = with_keys_of(lake.read(name).where(earlier).select("user_id", day), part.affected, ["user_id"])
                lake.upsert(name, late, gone=without_keys_of(held, late, ["user_id", day]))
            if fresh is not None:
                live = {d for d in lake.partitions("user_metrics") if d and d >= min(part.new)}
                scope = part.new | {d for d in lake.partitions(name) if d and d >= min(part.new)}
                lake.replace_dates(name, fresh, [d for d in lake.partitions(name) if d in scope and d not in live], touched=scope | live)
            self.since.append(min(dated))
        lake.settle(name, days)

    def carry(self) -> None:
        """Take the new days into the carried state, once both models of rolling days have them."""
        lake, days = self.lake, self.lake.pending("user_windows")
        if any(lake.pending(n) is None or lake.pending(n) for n in ("ml_features", "user_analytics")):
            return
        metrics = lake.read("user_metrics")
        dated = None if days is None else {d for d in days if d}
        if dated is None:
            self.state.rebuild(metrics, lake.watermark("user_metrics"))
        elif dated:
            part = carried.Slice(self.state, metrics, dated, True)
            states, gone = [], None
            if part.late:
                states.append(carried.state_of(carried.with_ever(part.history())))
                gone = without_keys_of(part.affected, part.history().select("user_id").distinct(), ["user_id"])
            if part.new:
                states.append(carried.state_of(part.following()))
            upto = max(d for d in (lake.watermark("user_metrics"), self.state.upto) if d)
            self.state.advance(reduce(DataFrame.unionByName, states), gone, upto)
        self.state.forget()
        lake.settle("user_windows", days)

    def user_registrations(self) -> None:
        metrics = self.lake.read("user_metrics")

        def part(days: set):
            rows = metrics.where(on_dates("date", days))
            return present.registrations(rows), days, {d for d in self.lake.partitions("user_metrics") if d in days}

        self.refresh("user_registrations", lambda: present.registrations(metrics), part)

    def business_metrics(self) -> None:
        metrics = read(self.lake, "user_metrics", self.as_of)

        def part(days: set):
            known = [d for d in self.lake.partitions("user_metrics") if d]
            _, emit = incremental.business_bounds(min(days), known)
            live = {d for d in known if d >= emit}
            scope = days | live | {d for d in self.lake.partitions("business_metrics") if d and d >= emit}
            return incremental.slice_business_metrics(metrics, min(days), known, self.as_of), scope, live

        self.refresh("business_metrics", lambda: mart.business_metrics(metrics, self.as_of), part)


def together(*steps: Callable[[], None]) -> None:
    """Independent models at the same time: short jobs of one fill the gaps of another.  All end before
    the first failure is raised."""
    failed: list[BaseException] = []

    def guarded(step: Callable[[], None]) -> Callable[[], None]:
        def run() -> None:
            try:
                step()
            except BaseException as e:  # handed to the caller below
                failed.append(e)

        return run

    threads = [InheritableThread(target=guarded(step)) for step in steps]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]


def run_models(
    lake: Lake,
    as_of: AsOf,
    enforce: Collection[str] = ALL_CHECKS,
    search_back_days: int | None = None,
    training: bool = False,
    expire_on: dt.date | None = None,
) -> DataFrame:
    """Bring every model up to date from the raw tables; returns yesterday's validity rows.

    Every model keeps the changed days it has not taken over yet, so days of late, moved or undated
    rows, of runs that a gate stopped and of runs that were lost are all caught up by the next run.
    ``search_back_days`` states how far the feed lets an event move.  ``training`` also rebuilds the
    training rows, whose labels look ahead; ``expire_on`` drops partitions past their retention.
    """
    # Different tables and pending days: what one of them stores, no other reads.
    together(lambda: _stage_events(lake, as_of, search_back_days), lambda: _stage_users(lake, as_of), lambda: _stage_sessions(lake, as_of))
    gate(lake, ("stg_events", "stg_users"), as_of, enforce, _waiting(lake, "user_metrics", "event_metrics"))

    models = _Models(lake, as_of)
    models.user_metrics()
    together(models.event_metrics, lambda: models.per_user("ml_features", curated.ml_features))
    gate(lake, ("user_metrics", "event_metrics", "ml_features"), as_of, enforce, _oldest(models.since))

    together(lambda: models.per_user("user_analytics", mart.user_analytics), models.business_metrics, models.user_registrations)
    gate(lake, ("user_analytics", "business_metrics"), as_of, enforce, _oldest(models.since))
    models.carry()

    events, users = lake.read("stg_events"), read(lake, "stg_users", as_of)
    if training:
        lake.replace("ml_training", mart.ml_training(read(lake, "user_metrics", as_of), read(lake, "ml_features", as_of), events, as_of))
    if expire_on is not None:
        for name in TABLES:
            if lake.exists(name):
                lake.expire(name, expire_on)
    return dag_quality_check(events, users, as_of)


def run_day(lake: Lake, incoming: DataFrame, day: dt.date, as_of: AsOf, enforce: Collection[str] = ALL_CHECKS, **options) -> DataFrame:
    """Append one day of raw events, then update every model."""
    lake.append_day("events", incoming, day)
    return run_models(lake, as_of, enforce, **options)
