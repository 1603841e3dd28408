"""Upsert, schema sync, append, retention and the read guard on stored tables."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from eventloom.operators.keyed import latest_per_key, sync_columns
from eventloom.sources import key_index, paths
from eventloom.sources import lake as lake_module
from eventloom.sources.lake import KeyOutOfBounds, UnboundedRead, retain
from tests.conftest import make_events, rows_of


def events_on(spark, *rows):
    return make_events(
        spark,
        [
            dict(event_id=i, user_id="u", event_type=kind, event_timestamp=at, created_at=at, metadata=tag)
            for i, kind, at, tag in rows
        ],
    )


def stored(lake):
    return rows_of(lake.read("events"), "event_id", "event_date", "metadata")


D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def test_upsert_replaces_moves_and_adds(spark, lake):
    lake.upsert("events", events_on(
        spark, ("a", "click", "2024-01-01 10:00:00", "old"), ("b", "click", "2024-01-02 10:00:00", "old"),
        ("c", "click", "2024-01-03 10:00:00", "old"),
    ))
    untouched = lake.path("events") + "/event_date=2024-01-03"
    before = spark.read.parquet(untouched).inputFiles()
    # a moves to the second day (emptying the first), b is corrected, d is new
    lake.upsert("events", events_on(
        spark, ("a", "click", "2024-01-02 09:00:00", "new"), ("b", "click", "2024-01-02 10:00:00", "new"),
        ("d", "click", "2024-01-02 11:00:00", "new"),
    ))
    assert stored(lake) == [("a", D2, "new"), ("b", D2, "new"), ("c", D3, "old"), ("d", D2, "new")]
    assert sorted(lake.partitions("events")) == [D2, D3]
    assert spark.read.parquet(untouched).inputFiles() == before


def test_upsert_keeps_newest_copy_and_all_keyless_rows(spark, lake):
    batch = events_on(
        spark, ("a", "click", "2024-01-01 10:00:00", "older"), ("a", "click", "2024-01-01 12:00:00", "newest"),
        (None, "click", "2024-01-01 10:00:00", "x"), (None, "click", "2024-01-01 10:00:00", "x"),
    )
    lake.upsert("events", batch)
    assert sorted(stored(lake), key=str) == [("a", D1, "newest"), (None, D1, "x"), (None, D1, "x")]


def test_rows_without_a_date_live_in_their_own_partition(spark, lake):
    lake.upsert("events", events_on(spark, ("a", "click", None, "old"), ("b", "click", "2024-01-01 10:00:00", "old")))
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 11:00:00", "new")))
    assert stored(lake) == [("a", D1, "new"), ("b", D1, "old")]
    assert lake.partitions("events") == [D1]


def test_upsert_is_idempotent(spark, lake):
    rows = events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), ("b", "view", "2024-01-02 10:00:00", "y"))
    lake.upsert("events", rows)
    lake.upsert("events", rows)
    assert len(stored(lake)) == 2


def test_hot_key_is_cut_before_the_exchange(spark):
    rows = events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"))
    plan = latest_per_key(rows, ["event_id"], ["event_timestamp"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")  # final one
    assert plan.count("WindowGroupLimit") == 2  # and a partial one on the map side


def test_schema_follows_the_newest_batch(spark, lake):
    first = events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"))
    lake.upsert("events", first)
    lake.upsert("events", events_on(spark, ("b", "click", "2024-01-02 10:00:00", "y")).drop("platform").withColumn("os", F.lit("linux")))
    got = lake.read("events")
    assert "platform" not in got.columns
    assert rows_of(got, "event_id", "os") == [("a", None), ("b", "linux")]


def test_sync_columns(spark):
    old = spark.createDataFrame([(1, "x")], "id int, gone string")
    new = spark.createDataFrame([(2, 1.5)], "id long, added double")
    synced = sync_columns(old, new)
    assert synced.dtypes == [("id", "bigint"), ("added", "double")]
    assert synced.first() == (1, None)


def test_append_day_twice(spark, lake):
    rows = events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), ("b", "click", "2024-01-02 10:00:00", "y"))
    for _ in range(2):
        lake.append_day("events", rows, D2)
    assert stored(lake) == [("b", D2, "y")]


def test_guard_and_pruning(spark, lake):
    lake.replace("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), ("b", "click", "2024-01-02 10:00:00", "y")))
    with pytest.raises(UnboundedRead):
        lake.scan("events")
    bounded = lake.scan("events", "2024-01-02")
    assert len(bounded.collect()) == 1
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_expired_partitions_are_dropped(spark, lake):
    lake.replace("events", events_on(spark, ("a", "click", "2016-01-01 10:00:00", "x"), ("b", "click", "2024-01-02 10:00:00", "y")))
    assert lake.expire("events", dt.date(2024, 1, 31)) == [dt.date(2016, 1, 1)]
    assert stored(lake) == [("b", D2, "y")]
    kept = retain(events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x")), "event_date", 30, "2024-01-31")
    assert kept.count() == 1
    assert retain(events_on(spark, ("a", "click", None, "x")), "event_date", 30, "2024-01-31").count() == 1


def test_emptied_day_disappears_from_models(spark, lake):
    lake.replace("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), ("b", "click", "2024-01-02 10:00:00", "y")))
    lake.replace_dates("events", events_on(spark, ("c", "click", "2024-01-01 10:00:00", "z")), gone=[D2])
    assert stored(lake) == [("c", D1, "z")]


def test_newest_reads_one_partition(spark, lake):
    lake.replace("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), ("b", "click", "2024-01-02 10:00:00", "y"), ("c", "click", None, "z")))
    newest = lake.newest("events")
    assert rows_of(newest, "event_id") == [("b",)]
    assert "PartitionFilters: [isnotnull(event_date" in newest._jdf.queryExecution().executedPlan().toString()
    lake.replace("events", events_on(spark, ("c", "click", None, "z")))
    assert rows_of(lake.newest("events"), "event_id") == [("c",)]


def test_watermark_comes_from_the_listing(spark, lake):
    assert lake.watermark("events") is None
    lake.replace("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), ("b", "click", None, "y")))
    assert lake.watermark("events") == D1


def test_keys_that_move_too_far_stop_the_upsert(spark, lake):
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "old"), ("b", "click", "2024-01-02 10:00:00", "old")))
    before = stored(lake)
    moved = events_on(spark, ("a", "click", "2024-01-03 10:00:00", "new"), ("b", "click", "2024-01-03 10:00:00", "new"))
    with pytest.raises(KeyOutOfBounds, match="1 keys"):
        lake.upsert("events", moved, 1)
    assert stored(lake) == before
    assert lake.upsert("events", moved, 2) == {D1, D2, D3}
    assert stored(lake) == [("a", D3, "new"), ("b", D3, "new")]


def test_rows_without_a_key_are_counted_by_content(spark, lake):
    rows = events_on(
        spark, (None, "click", "2024-01-01 10:00:00", "x"), (None, "click", "2024-01-01 10:00:00", "x"), ("", "click", "2024-01-01 10:00:00", "y"),
        ("", "click", "2024-01-01 11:00:00", "z"), (None, "click", None, "w"), ("a", "click", None, "v"),
    )
    for _ in range(3):
        lake.upsert("events", rows)
        assert sorted(stored(lake), key=str) == sorted([("", D1, "y"), ("", D1, "z"), ("a", None, "v"), (None, D1, "x"), (None, D1, "x"), (None, None, "w")], key=str)
    lake.upsert("events", rows.unionByName(rows))  # the same content more often is more rows
    assert len(stored(lake)) == 11


def test_version_that_arrived_earlier_does_not_win(spark, lake):
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-03 10:00:00", "new")))
    assert lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "old"))) == set()
    assert stored(lake) == [("a", D3, "new")]


def test_lost_swap_is_finished_by_the_next_access(spark, lake, monkeypatch):
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "old"), ("b", "click", "2024-01-02 10:00:00", "old")))
    move, moved = paths.move, []

    def lost(spark, source, target):
        if moved:
            raise RuntimeError("driver lost")
        moved.append(target)
        move(spark, source, target)

    monkeypatch.setattr(paths, "move", lost)
    with pytest.raises(RuntimeError):
        lake.upsert("events", events_on(spark, ("a", "click", "2024-01-02 10:00:00", "new"), ("c", "click", "2024-01-03 10:00:00", "new")))
    monkeypatch.setattr(paths, "move", move)
    assert stored(lake) == [("a", D2, "new"), ("b", D2, "old"), ("c", D3, "new")]


def test_retyped_column_is_changed_in_all_partitions(spark, lake):
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "1"), ("b", "click", "2024-01-02 10:00:00", "2")).withColumn("n", F.lit(1).cast("long")))
    lake.upsert("events", events_on(spark, ("c", "click", "2024-01-03 10:00:00", "3")).withColumn("n", F.lit("x")))
    assert rows_of(lake.read("events"), "event_id", "n") == [("a", "1"), ("b", "1"), ("c", "x")]


def test_nothing_is_left_in_scratch(spark, lake):
    import os

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    for text in ("x", "y"):
        lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", text)))
    assert set(os.listdir(shared)) == before and not os.listdir(f"{lake.root}/_staged")


def test_append_day_loads_rows_without_a_date(spark, lake):
    rows = events_on(spark, ("a", "click", None, "x"), ("b", "click", "2024-01-02 10:00:00", "y"), (None, "click", None, "z"))
    for _ in range(2):
        lake.append_day("events", rows, D2)
    assert stored(lake) == [("a", None, "x"), ("b", D2, "y"), (None, None, "z")]


def test_scratch_lives_in_the_shared_folder(spark):
    from eventloom.sources.paths import scratch_dir

    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


# --- key index, files, deliveries -----------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def data_files(lake, name="events"):
    return {f"{d}/{f}" for d in paths.children(lake.spark, lake.path(name)) if "=" in d for f in paths.files(lake.spark, f"{lake.path(name)}/{d}")}


def test_one_row_correction_reads_one_bucket_and_rewrites_one_file(spark, lake, monkeypatch):
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 10)
    rows = [(f"k{i}", "click", f"2024-01-0{1 + i % 5} 10:00:00", "old") for i in range(100)]
    lake.upsert("events", events_on(spark, *rows))
    for i in range(100, 103):  # more files in the first day
        lake.upsert("events", events_on(spark, (f"k{i}", "click", "2024-01-01 11:00:00", "old")))
    before = data_files(lake)
    assert len([f for f in before if "2024-01-01" in f]) >= 4
    fix = events_on(spark, ("k5", "click", "2024-01-01 10:00:00", "new"))
    index = lake.index("events")
    found = index.matches(fix)
    assert found.count() == 1 and index.dates(fix) == {D1}
    assert re.search(r"PartitionFilters: \[.*_bucket#\d+ (?:= \d+|IN \(\d+\))", plan_of(found))
    assert index.entries().select("_bucket").distinct().count() == 10
    assert lake.upsert("events", fix) == {D1}
    after = data_files(lake)
    assert len(before - after) == 1 and len(after - before) == 2  # its other rows, and the corrected one
    assert ("k5", D1, "new") in stored(lake) and len(stored(lake)) == 103


def test_index_follows_moves_replacements_and_compaction(spark, lake, monkeypatch):
    monkeypatch.setattr(key_index, "MAX_APPENDS", 2)
    lake.replace("events", events_on(spark, *[(f"k{i}", "click", "2024-01-01 10:00:00", "v0") for i in range(5)]))
    for n in range(1, 7):
        lake.upsert("events", events_on(spark, ("k1", "click", f"2024-01-0{1 + n} 10:00:00", f"v{n}")))
        assert ("k1", dt.date(2024, 1, 1 + n), f"v{n}") in stored(lake) and len(stored(lake)) == 5
    lake.replace_dates("events", events_on(spark, ("x", "click", "2024-01-02 10:00:00", "whole day")))
    lake.upsert("events", events_on(spark, ("x", "click", "2024-01-03 10:00:00", "moved")))
    assert [r for r in stored(lake) if r[0] == "x"] == [("x", D3, "moved")]
    paths.remove(spark, lake.index("events").where)  # a table of before there were indexes
    lake.upsert("events", events_on(spark, ("x", "click", "2024-01-04 10:00:00", "again")))
    assert [r for r in stored(lake) if r[0] == "x"] == [("x", dt.date(2024, 1, 4), "again")] and lake.index("events").exists()


def test_crowded_partition_is_rewritten(spark, lake, monkeypatch):
    monkeypatch.setattr(lake_module, "MAX_FILES", 4)
    for i in range(9):
        lake.upsert("events", events_on(spark, (f"k{i}", "click", "2024-01-01 10:00:00", "x")))
    assert len(data_files(lake)) <= 4 and len(stored(lake)) == 9


def test_lost_file_swap_is_finished_by_the_next_access(spark, lake, monkeypatch):
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "old"), ("b", "click", "2024-01-01 10:00:00", "old")))
    remove = paths.remove

    def lost(spark, path):
        if path.startswith(lake.path("events")):  # the new files are in, the old one is still there
            raise RuntimeError("driver lost")
        remove(spark, path)

    monkeypatch.setattr(paths, "remove", lost)
    with pytest.raises(RuntimeError):
        lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "new")))
    monkeypatch.setattr(paths, "remove", remove)
    assert stored(lake) == [("a", D1, "new"), ("b", D1, "old")]


def test_retried_delivery_keeps_late_and_moved_rows(spark, lake):
    """The table is the key-wise union of what was delivered, whatever is loaded again."""
    day = events_on(spark, ("a", "click", "2024-01-02 10:00:00", "first"), ("b", "click", "2024-01-02 10:00:00", "first"), (None, "click", "2024-01-02 10:00:00", "x"))
    lake.append_day("events", day, D2)
    lake.upsert("events", events_on(spark, ("late", "click", "2024-01-02 23:00:00", "late"), ("b", "click", "2024-01-03 10:00:00", "moved")))
    want = sorted([("a", D2, "first"), ("b", D3, "moved"), ("late", D2, "late"), (None, D2, "x")], key=str)
    for _ in range(2):
        lake.append_day("events", day, D2)
        assert sorted(stored(lake), key=str) == want


def test_retried_delivery_replaces_what_it_brought(spark, lake):
    lake.append_day("events", events_on(
        spark, ("a", "click", "2024-01-02 10:00:00", "first"), ("wrong", "click", "2024-01-02 10:00:00", "first"), ("fixed", "click", "2024-01-02 10:00:00", "first"),
        (None, "click", "2024-01-02 10:00:00", "x"), (None, "click", "2024-01-02 10:00:00", "x"), (None, "click", "2024-01-02 10:00:00", "y"), ("", "click", None, "z"),
    ), D2)
    lake.upsert("events", events_on(spark, ("fixed", "click", "2024-01-02 12:00:00", "corrected elsewhere"), ("other", "click", "2024-01-02 12:00:00", "o")))
    again = events_on(spark, ("a", "click", "2024-01-02 11:00:00", "second"), (None, "click", "2024-01-02 10:00:00", "x"), ("new", "click", "2024-01-02 10:00:00", "n"))
    for _ in range(2):
        lake.append_day("events", again, D2)
        assert sorted(stored(lake), key=str) == sorted([
            ("a", D2, "second"), ("fixed", D2, "corrected elsewhere"), ("other", D2, "o"), (None, D2, "x"), ("new", D2, "n"),
        ], key=str)


def test_delivery_lost_half_way_is_repaired(spark, lake, monkeypatch):
    lake.append_day("events", events_on(spark, ("a", "click", "2024-01-02 10:00:00", "1"), ("b", "click", "2024-01-02 10:00:00", "1")), D2)
    replace = paths.replace
    monkeypatch.setattr(paths, "replace", lambda *a: 1 / 0)  # stored, but the ledger not yet
    with pytest.raises(ZeroDivisionError):
        lake.append_day("events", events_on(spark, ("a", "click", "2024-01-02 10:00:00", "1"), ("c", "click", "2024-01-02 10:00:00", "2")), D2)
    monkeypatch.setattr(paths, "replace", replace)
    assert stored(lake) == [("a", D2, "1"), ("c", D2, "2")]
    lake.append_day("events", events_on(spark, ("a", "click", "2024-01-02 10:00:00", "1")), D2)
    assert stored(lake) == [("a", D2, "1")]


def test_rows_with_a_key_are_laid_out_once(spark, lake, monkeypatch):
    """Key-less rows beside them do not make an upsert write the others again, and a large batch needs no index."""
    monkeypatch.setattr(key_index, "FEW_KEYS", 1)
    rows = events_on(spark, *[(f"k{i}", "click", "2024-01-01 10:00:00", "old") for i in range(6)], (None, "click", "2024-01-01 10:00:00", "x"), ("", "click", None, "y"))
    lake.upsert("events", rows)
    assert not lake.index("events").exists()
    written, stage = [], lake._stage
    monkeypatch.setattr(lake, "_stage", lambda name, df, *a: written.append(df.count()) or stage(name, df, *a))
    more = events_on(
        spark, *[(f"k{i}", "click", "2024-01-02 10:00:00", "new") for i in range(4, 9)],
        (None, "click", "2024-01-01 10:00:00", "x"), (None, "click", "2024-01-01 10:00:00", "x"), ("", "click", None, "y"),
    )
    assert lake.upsert("events", more) == {D1, D2}
    # one copy more without a key, and what stays of the only file of the first day: four keys and a row without
    assert written == [6] and not lake.index("events").exists()
    want = [(f"k{i}", D1, "old") for i in range(4)] + [(f"k{i}", D2, "new") for i in range(4, 9)] + [(None, D1, "x")] * 2 + [("", None, "y")]
    assert sorted(stored(lake), key=str) == sorted(want, key=str)
    assert not paths.children(spark, f"{lake.root}/_staged")


def test_rows_are_dealt_by_key_only_if_one_repeats(spark, lake, monkeypatch):
    seen = []
    monkeypatch.setattr(lake_module, "latest_per_key", lambda df, *a: seen.append(1) or latest_per_key(df, *a))
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), (None, "click", "2024-01-01 10:00:00", "x"), (None, "click", "2024-01-01 10:00:00", "x")))
    assert not seen
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 11:00:00", "older"), ("a", "click", "2024-01-01 12:00:00", "newest")))
    assert seen and sorted(stored(lake), key=str) == [("a", D1, "newest"), (None, D1, "x"), (None, D1, "x")]


def test_upsert_by_a_key_that_holds_the_day(spark, lake):
    rows = lambda *r: spark.createDataFrame(list(r), "user_id string, date date, total_events long")
    lake.replace("user_metrics", rows(("a", D1, 1), ("a", D2, 2), ("b", D1, 3)))
    assert lake.upsert("user_metrics", rows(("a", D1, 5), ("c", D2, 6)), marks=()) == {D1, D2}
    assert rows_of(lake.read("user_metrics"), "user_id", "date", "total_events") == [("a", D1, 5), ("a", D2, 2), ("b", D1, 3), ("c", D2, 6)]


def test_a_file_whose_rows_are_all_replaced_is_not_read(spark, lake, monkeypatch):
    rows = [(f"k{i}", "click", "2024-01-01 10:00:00", "old") for i in range(4)]
    lake.upsert("events", events_on(spark, *rows, ("a", "click", "2024-01-02 10:00:00", "old"), ("b", "click", "2024-01-02 10:00:00", "old")))
    read, read_files = [], lake._read_files
    monkeypatch.setattr(lake, "_read_files", lambda name, files: read.append({f.split("/")[0] for f in files}) or read_files(name, files))
    assert lake.upsert("events", events_on(spark, *rows)) == {D1}  # a replay
    assert not read
    # all rows of the first day, one of the second
    lake.upsert("events", events_on(spark, *[(k, kind, at, "new") for k, kind, at, _ in rows], ("a", "click", "2024-01-02 10:00:00", "new")))
    assert read == [{"event_date=2024-01-02"}]
    assert stored(lake) == [("a", D2, "new"), ("b", D2, "old")] + [(f"k{i}", D1, "new") for i in range(4)]


def test_files_that_share_a_checksum_are_all_read(spark, lake, monkeypatch):
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-01 10:00:00", "old"), ("b", "click", "2024-01-01 10:00:00", "old")))
    lake.upsert("events", events_on(spark, ("c", "click", "2024-01-01 10:00:00", "old")))
    real = lake_module.F.crc32
    monkeypatch.setattr(lake_module.F, "crc32", lambda c: real(F.lit("")))
    monkeypatch.setattr(lake_module.zlib, "crc32", lambda text: 0)
    lake.upsert("events", events_on(spark, ("a", "click", "2024-01-02 10:00:00", "new"), ("b", "click", "2024-01-02 10:00:00", "new")))
    assert stored(lake) == [("a", D2, "new"), ("b", D2, "new"), ("c", D1, "old")]


def test_a_delivery_reads_its_source_once(spark, lake, tmp_path, monkeypatch):
    events_on(spark, ("a", "click", "2024-01-01 10:00:00", "x"), ("b", "click", None, "y")).write.parquet(str(tmp_path / "landing"))
    seen, upsert = [], lake.upsert
    monkeypatch.setattr(lake, "upsert", lambda name, rows, **k: seen.extend(rows.inputFiles()) or upsert(name, rows, **k))
    for _ in range(2):
        lake.append_day("events", spark.read.parquet(str(tmp_path / "landing")), D1)
    assert seen and not any("/landing/" in f for f in seen)
    assert stored(lake) == [("a", D1, "x"), ("b", None, "y")]
