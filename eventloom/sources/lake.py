"""Date-partitioned parquet tables below one root: <root>/<layer>/<table>/<date column>=.../"""

from __future__ import annotations

import datetime as dt
import json
import uuid
import zlib
from collections.abc import Callable, Collection, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventloom.functions.expressions import AsOf, as_of_date
from eventloom.operators.keyed import content_of, has_key, latest_per_key, missing_copies, repeats_keys, sync_columns, with_keys_of, without_keys_of
from eventloom.sources import paths
from eventloom.sources.catalog import DOWNSTREAM, STATES, TABLES, Table
from eventloom.sources.key_index import KeyIndex

_NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_KEYED = "_has_key"
MAX_FILES = 64  # of one partition; more are rewritten as one when it next gains rows


class UnboundedRead(ValueError):
    """A guarded table was read without bounds on its partition date."""


class KeyOutOfBounds(ValueError):
    """A key moved further than the feed guarantees."""


Days = set  # of partition dates; the NULL date is a partition of its own


def spread(df: DataFrame, date_col: str, cluster: Sequence[str], first: str | None = None) -> DataFrame:
    """Lay rows out for a partitioned write.

    Rebalancing by date keeps the files per day few, and adaptive execution cuts a day with too
    many rows into several tasks (repartition by date would give a whole day to one task).
    Sorting by the cluster columns gives narrow row-group statistics to skip by.  ``first`` is a
    partition column above the date.
    """
    by = [c for c in (first, date_col, *cluster) if c in df.columns]
    return df.hint("rebalance", F.col(date_col)).sortWithinPartitions(*dict.fromkeys(by))


def write_table(
    df: DataFrame, path: str, date_col: str, cluster: Sequence[str] = (), only_dates_present: bool = False, mode: str = "overwrite"
) -> None:
    """Overwrite a table, or only the partitions that occur in ``df``; or add files to it."""
    writer = spread(df, date_col, cluster).write.mode(mode).partitionBy(date_col)
    writer.option("partitionOverwriteMode", "dynamic" if only_dates_present else "static").parquet(path)


def on_dates(column: str, dates: Iterable[dt.date | None]) -> Column:
    """Literal date filter, so it prunes partitions; a NULL date is its own partition."""
    dates = list(dates)
    known = [d for d in dates if d is not None]
    c = F.col(column).isin(known) if known else F.lit(False)
    return c | F.col(column).isNull() if None in dates else c


def dates_of(df: DataFrame, column: str) -> set[dt.date | None]:
    # At most one value per partition of the table reaches the driver.
    return {r[0] for r in df.select(column).distinct().collect()}


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- reading ---------------------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{TABLES[name].layer}/{name}"

    def _schema_path(self, name: str) -> str:
        return f"{self.root}/_schemas/{name}.json"

    def exists(self, name: str) -> bool:
        return paths.exists(self.spark, self._schema_path(name))

    def read(self, name: str) -> DataFrame:
        """The table in its current schema; files older than a column give NULL for it."""
        self._finish(name)
        schema = StructType.fromJson(json.loads(paths.read_text(self.spark, self._schema_path(name))))
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.fieldNames())

    def scan(self, name: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        """Guarded read: a large table must be bounded on its partition date."""
        table = TABLES[name]
        if table.needs_filter and date_from is None and date_to is None:
            raise UnboundedRead(f"{name}: give date_from or date_to on {table.date_col}")
        df = self.read(name)
        day = F.col(table.date_col)
        if date_from is not None:
            df = df.where(day >= F.lit(date_from).cast("date"))
        if date_to is not None:
            df = df.where(day <= F.lit(date_to).cast("date"))
        return df

    def partitions(self, name: str) -> list[dt.date | None]:
        """Partition dates from the directory listing, no scan."""
        self._finish(name)
        prefix = f"{TABLES[name].date_col}="
        found = [c[len(prefix):] for c in paths.children(self.spark, self.path(name)) if c.startswith(prefix)]
        return [None if f == _NO_DATE else dt.date.fromisoformat(f) for f in found]

    def watermark(self, name: str) -> dt.date | None:
        """Newest partition date, the start of the next incremental slice."""
        return max((d for d in self.partitions(name) if d), default=None) if self.exists(name) else None

    def newest(self, name: str) -> DataFrame:
        """The newest dated partition: enough for the newest value of what the date comes from."""
        day = self.watermark(name)
        df = self.read(name)
        return df if day is None else df.where(F.col(TABLES[name].date_col) == F.lit(day))

    # --- pending days ------------------------------------------------------------------------

    def _pending_path(self, name: str) -> str:
        return f"{self.root}/_pending/{name}.json"

    def pending(self, name: str) -> Days | None:
        """Days of the table above that changed since ``name`` last took them over; None: every day."""
        if not (name in STATES or self.exists(name)) or not paths.exists(self.spark, self._pending_path(name)):
            return None
        days = json.loads(paths.read_text(self.spark, self._pending_path(name)))
        return None if days is None else {d and dt.date.fromisoformat(d) for d in days}

    def _set_pending(self, name: str, days: Days | None) -> None:
        text = None if days is None else sorted((d and d.isoformat() for d in days), key=str)
        paths.write_text(self.spark, self._pending_path(name), json.dumps(text))

    def _mark(self, name: str, touched: Days | None, marks: Sequence[str] | None = None) -> None:
        """Before a table changes, its changing days become pending below it, so no crash can lose them."""
        for below in DOWNSTREAM.get(name, ()) if marks is None else marks:
            self.add_pending(below, touched)

    def add_pending(self, name: str, days: Days | None) -> None:
        """``name`` has to take these days over; None: every day."""
        known = self.pending(name)
        self._set_pending(name, None if days is None or known is None else known | days)

    def settle(self, name: str, days: Days | None) -> None:
        """``name`` has taken these days over."""
        known = self.pending(name)
        self._set_pending(name, set() if days is None or known is None else known - days)

    # --- writing ---------------------------------------------------------------------------

    def _journal_path(self, name: str) -> str:
        return f"{self.root}/_journal/{name}.json"

    def index(self, name: str) -> KeyIndex:
        return KeyIndex(self.spark, self.root, TABLES[name])

    def _stage(self, name: str, df: DataFrame, staged: str | None = None) -> str:
        """Write rows in the layout of the table beside it, or add them to what is there already."""
        where = staged or f"{self.root}/_staged/{name}-{uuid.uuid4().hex}"
        write_table(df, where, TABLES[name].date_col, TABLES[name].cluster, mode="append")
        return where

    def _commit(
        self,
        name: str,
        df: DataFrame,
        gone: Iterable[dt.date | None] = (),
        touched: Days | None = None,
        full: bool = False,
        replaced_files: Iterable[str] | None = None,
        marks: Sequence[str] | None = None,
        staged: str | None = None,
    ) -> None:
        """Swap in the partitions of ``df`` and drop those in ``gone`` (all others, with ``full``).

        With ``replaced_files`` the files of ``df`` are added to the partitions instead, and those files
        disappear.  What is new is written beside the table, then a journal says what is to be
        swapped.  A job lost before the journal leaves the table as it was; one lost after it is
        finished by the next access.  Readers may see some partitions new and some old while the swap
        runs.  ``marks`` names the models for which the days become pending, by default all below.
        ``staged`` is where the rows of ``df`` have been written already.
        """
        table = TABLES[name]
        staged = staged or self._stage(name, df)
        prefix = f"{table.date_col}="
        new = [c for c in paths.children(self.spark, staged) if c.startswith(prefix)]
        nullable = StructType([type(f)(f.name, f.dataType, True) for f in df.schema])
        journal = {"staged": staged, "new": [], "dropped": [], "added": [], "removed": [], "schema": nullable.json()}
        if replaced_files is not None:
            journal |= {"added": new, "removed": sorted(replaced_files)}
        else:
            old = [c for c in paths.children(self.spark, self.path(name)) if c.startswith(prefix)] if full else []
            dropped = [c for c in old if c not in new] if full else [f"{prefix}{_NO_DATE if d is None else d}" for d in gone]
            journal |= {"new": new, "dropped": [c for c in dropped if c not in new]}
        self._mark(name, touched, marks)
        index = None if table.key_fixes_date else self.index(name)
        if index and full:
            index.drop()  # the first small batch builds it again
        elif index and new and index.exists():
            index.add(self.spark.read.schema(nullable).parquet(staged))
        paths.write_text(self.spark, self._journal_path(name), json.dumps(journal))
        self._finish(name)

    def _finish(self, name: str) -> None:
        """Carry out what the journal of the table says; every step can be repeated."""
        if not paths.exists(self.spark, self._journal_path(name)):
            return
        journal = json.loads(paths.read_text(self.spark, self._journal_path(name)))
        spark, staged, home = self.spark, journal["staged"], self.path(name)
        paths.make(spark, home)
        for child in journal["new"]:
            paths.replace(spark, f"{staged}/{child}", f"{home}/{child}")
        for child in journal["dropped"]:
            paths.remove(spark, f"{home}/{child}")
        for child in journal["added"]:
            for file in paths.files(spark, f"{staged}/{child}"):
                paths.move(spark, f"{staged}/{child}/{file}", f"{home}/{child}/{file}")
        for file in journal["removed"]:
            paths.remove(spark, f"{home}/{file}")
        for child in {f.rsplit("/", 1)[0] for f in journal["removed"]}:
            if not paths.files(spark, f"{home}/{child}"):
                paths.remove(spark, f"{home}/{child}")
        paths.write_text(spark, self._schema_path(name), journal["schema"])
        paths.remove(spark, self._journal_path(name))
        paths.remove(spark, staged.split(f"/{_KEYED}=")[0])

    def replace(self, name: str, df: DataFrame) -> None:
        """Full load: the table becomes exactly ``df``."""
        self._commit(name, df, full=True)

    def replace_dates(self, name: str, df: DataFrame, gone: Iterable[dt.date | None] = (), touched: Days | None = None) -> None:
        """The partitions that occur in ``df`` become exactly ``df``, those in ``gone`` disappear.

        For models that recompute whole days: one write, no read of the table, safe to repeat.
        ``touched`` names the days that may have changed; unless given, every day counts as changed.
        A column that changes its type is changed in all other partitions too.
        """
        table = TABLES[name]
        if self.exists(name) and self._retyped(name, df):
            current = self.read(name)
            mine = dates_of(df, table.date_col) | set(gone)
            rest = [d for d in self.partitions(name) if d not in mine]
            df = df.unionByName(sync_columns(current.where(on_dates(table.date_col, rest)), df))
        self._commit(name, df, gone, touched)

    def _retyped(self, name: str, df: DataFrame) -> bool:
        """Whether a column of the stored table has another type in ``df``: files cannot be mixed then."""
        types = dict(df.dtypes)
        return any(types.get(c, t) != t for c, t in self.read(name).dtypes)

    def append_day(self, name: str, staged: DataFrame, day: dt.date) -> None:
        """Load one day into a table, and the rows without a date, which belong to no day.

        The day is one delivery: loading it again replaces what it brought before, and nothing else.
        """
        date_col = TABLES[name].date_col
        self.deliver(name, staged.where((F.col(date_col) == F.lit(day)) | F.col(date_col).isNull()), day.isoformat())

    def _ledger(self, name: str) -> str:
        return f"{self.root}/_deliveries/{name}"

    def deliver(self, name: str, rows: DataFrame, delivery: str) -> Days:
        """Load one delivery; loading it again replaces the rows that came with it by what it holds now.

        A ledger keeps the content and the key of what each delivery brought.  Rows that came late
        under the same dates, in other deliveries or as corrections, stay as they are; a row that has
        moved on to another date is not brought back; a row that the delivery no longer holds goes, if it
        still says what the delivery said.  The ledger holds both attempts while the rows are being
        exchanged, so a lost load is repaired by the next attempt.
        """
        aside = paths.scratch_dir(self.spark, f"delivery-{name}")
        try:
            # Looked at several times below: a landing zone that holds many days is scanned once.
            rows.write.parquet(aside)
            return self._deliver(name, self.spark.read.schema(rows.schema).parquet(aside), delivery)
        finally:
            paths.remove(self.spark, aside)

    def _deliver(self, name: str, rows: DataFrame, delivery: str) -> Days:
        table = TABLES[name]
        where, contents = f"{self._ledger(name)}/delivery={delivery}", ["_content1", "_content2"]
        keys = [F.first(k).alias(k) for k in table.keys]
        brought = rows.withColumns(content_of(rows)).groupBy(*contents).agg(*keys, F.first(table.date_col).alias("_day"), F.count("*").alias("_copies"))
        if not paths.exists(self.spark, where):
            brought.write.parquet(where)
            return self.upsert(name, rows)
        brought = self.materialise(brought, f"brought-{name}")
        before = self.spark.read.schema(brought.schema).parquet(where).groupBy(*contents).agg(*keys, F.first("_day").alias("_day"), F.max("_copies").alias("_before"))
        left = F.col("_before") - F.coalesce("_copies", F.lit(0))
        lacking = before.join(brought.select(*contents, "_copies"), contents, "left").withColumn("_copies", left).where("_copies > 0").drop("_before")
        # A key that the delivery still holds is replaced or kept by the rules of the upsert.
        lacking = lacking.where(~has_key(table.keys)).unionByName(without_keys_of(lacking.where(has_key(table.keys)), rows, table.keys))
        withdrawn = self.materialise(lacking, f"withdrawn-{name}")
        brought.write.mode("append").parquet(where)
        touched = self.upsert(name, rows, withdrawn=None if withdrawn.isEmpty() else withdrawn)
        fresh = f"{self.root}/_staged/ledger-{uuid.uuid4().hex}"
        brought.write.parquet(fresh)
        paths.replace(self.spark, fresh, where)
        return touched

    def materialise(self, df: DataFrame, label: str) -> DataFrame:
        """Write to the shared scratch folder and read back: a lineage cut that survives lost executors."""
        path = paths.scratch_dir(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _with_files(self, name: str) -> DataFrame:
        """The table with the file of each row as ``_file``, which is unique within a partition."""
        schema = StructType.fromJson(json.loads(paths.read_text(self.spark, self._schema_path(name))))
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.fieldNames(), F.col("_metadata.file_name").alias("_file"))

    def _child(self, name: str, day: dt.date | None) -> str:
        return f"{TABLES[name].date_col}={_NO_DATE if day is None else day}"

    def _read_files(self, name: str, files: Collection[str]) -> DataFrame:
        """Those files of the table and no others; metadata of one file each reached the driver before."""
        schema = StructType.fromJson(json.loads(paths.read_text(self.spark, self._schema_path(name))))
        if not files:
            return self.spark.createDataFrame([], schema)
        home = self.path(name)
        return self.spark.read.schema(schema).option("basePath", home).parquet(*[f"{home}/{f}" for f in sorted(files)]).select(*schema.fieldNames())

    def patch(self, name: str, keyed: DataFrame, change: Callable[[DataFrame], DataFrame], marks: Sequence[str] | None = None) -> Days:
        """Store ``change`` of the files that hold a row with a key of ``keyed``; returns their days.

        ``change`` sees all rows of these files and leaves their number, their keys and dates as they
        are.  One look at the key columns, one read and one write.  ``marks``: see ``_commit``.
        """
        self._finish(name)
        day, keys = TABLES[name].date_col, keyed.columns
        held = with_keys_of(self._with_files(name).select(*dict.fromkeys([*keys, day]), "_file"), keyed, keys)
        places = held.select(day, "_file").distinct().collect()  # a file each at most
        touched = {r[day] for r in places}
        if places:
            files = {f"{self._child(name, r[day])}/{r['_file']}" for r in places}
            self._commit(name, change(self._read_files(name, files)), touched=touched, replaced_files=files, marks=marks)
        return touched

    def _crowded(self, name: str, days: Days) -> set[str]:
        """The files of those partitions among ``days`` that hold many: rewriting them is due."""
        out: set[str] = set()
        for d in days:
            child = self._child(name, d)
            found = paths.files(self.spark, f"{self.path(name)}/{child}")
            if len(found) >= MAX_FILES:
                out |= {f"{child}/{f}" for f in found}
        return out

    def upsert(
        self,
        name: str,
        batch: DataFrame,
        search_back_days: int | None = None,
        withdrawn: DataFrame | None = None,
        gone: DataFrame | None = None,
        marks: Sequence[str] | None = None,
    ) -> Days:
        """Replace rows with the batch's keys, add the others, adopt the batch's columns.

        Returns the days that gained or lost rows.  For a few keys the key index says in which partitions
        they can be, for more the key column of the table; only files that hold one of them are rewritten
        (all, when a column changes its type), and of these a file whose every row is replaced is not read.
        ``search_back_days`` states how far the feed lets keys move; a key that moved further raises
        KeyOutOfBounds before anything is written.

        Rows whose key is NULL or blank are matched by content and counted: a replay adds none.  A
        version that arrived before the stored one does not replace it.  ``withdrawn`` (content, day,
        copies) and ``gone`` (keys) name rows that disappear.  ``marks``: see ``_commit``.
        """
        table: Table = TABLES[name]
        if repeats_keys(batch, table.keys):  # whole rows are dealt by key only if that can matter
            batch = latest_per_key(batch, table.keys, table.newest_first)
        self._finish(name)
        if not self.exists(name):
            self.replace(name, batch)
            return set(self.partitions(name))
        day, order = table.date_col, batch.columns
        staged = f"{self.root}/_staged/{name}-{uuid.uuid4().hex}"
        aside = [staged]

        def keep(df: DataFrame, label: str) -> DataFrame:  # used several times below
            aside.append(paths.scratch_dir(self.spark, f"upsert-{name}-{label}"))
            df.write.parquet(aside[-1])
            return self.spark.read.schema(df.schema).parquet(aside[-1])

        try:
            # Most rows with a key go in as they are: they are written once, in the layout of the table,
            # apart from those without a key.
            keyed, loose = self._stage_apart(name, batch, staged)
            n_keyed, gaining, loose_days = self._spans(keyed, loose, day)
            stored = self._with_files(name)
            target = sync_columns(stored, batch.withColumn("_file", F.lit("")))
            places: list = []
            replaced: set[str] = set()  # files of which the batch has every row
            whole = True  # every row with a key goes in
            candidates = self._dates_with(name, keyed, gaining, n_keyed) if gaining else set()
            if candidates:
                arrival = [c for c in (table.arrival,) if c in target.columns]
                late = F.coalesce(F.col(arrival[0]) > F.col("_arrived"), F.lit(False)) if arrival else F.lit(False)
                mine = keyed.select(*table.keys, *[F.col(c).alias("_arrived") for c in arrival])
                where = list(dict.fromkeys([*table.keys, day]))  # a key may hold the day
                # The rows travel with a checksum of their file's name instead of the name.
                held = target.where(on_dates(day, candidates)).select(*where, F.crc32("_file").alias("_file"), *arrival)
                found = held.join(mine, list(table.keys)).select(*where, "_file", late.alias("_late"))
                if search_back_days is not None:
                    found = keep(found, "found")
                    self._check_bound(name, keyed, found, search_back_days)
                hits = found.groupBy(day, "_file").agg(F.max("_late").alias("late"), F.count("*").alias("n")).collect()  # a file each at most
                if any(r.late for r in hits):
                    older = keep(found.where("_late").select(*table.keys).distinct(), "older")
                    keyed, found, whole = without_keys_of(keyed, older, table.keys), without_keys_of(found, older, table.keys), False
                    gaining = dates_of(keyed, day)
                    hits = found.groupBy(day, "_file").agg(F.count("*").alias("n")).collect()
                named = self._named(target, day, {(r[day], r["_file"]): r.n for r in hits})
                replaced = {f"{self._child(name, d)}/{file}" for d, file, all_rows in named if all_rows}
                hits = [(d, file) for d, file, _ in named]
                places += hits
            content = list(content_of(batch))
            if withdrawn is not None:
                hit = target.where(on_dates(day, {r[0] for r in withdrawn.select("_day").distinct().collect()}))
                hit = hit.withColumns(content_of(hit.drop("_file"))).join(withdrawn.select(*content), content, "left_semi")
                places += hit.select(day, "_file").distinct().collect()
            if gone is not None:
                gone = keep(gone.select(*table.keys, *[c for c in (day,) if c not in table.keys]), "gone")
                hit = with_keys_of(target.where(on_dates(day, dates_of(gone, day))), gone, table.keys)
                places += hit.select(day, "_file").distinct().collect()
            if loose_days:
                loose = keep(self._lacking(target.drop("_file"), loose, table), "loose")
                loose_days = dates_of(loose, day)
            touched = gaining | loose_days | {r[0] for r in places}

            def kept(rows: DataFrame) -> DataFrame:
                rows = without_keys_of(sync_columns(rows, batch), keyed, table.keys)
                if gone is not None:
                    rows = without_keys_of(rows, gone, table.keys)
                if withdrawn is None:
                    return rows
                copy = F.row_number().over(Window.partitionBy(*content).orderBy(*content))
                counted = rows.withColumns(content_of(rows)).join(withdrawn.select(*content, "_copies"), content, "left")
                return counted.withColumn("_copy", copy).where(F.col("_copies").isNull() | (F.col("_copy") > F.col("_copies"))).select(rows.columns)

            if self._retyped(name, batch):
                new = keyed.unionByName(loose) if loose_days else keyed
                self._commit(name, kept(target.drop("_file")).unionByName(new), touched=touched, full=True, marks=marks)
            elif touched or order != stored.columns[:-1]:
                files = {f"{self._child(name, r[0])}/{r[1]}" for r in places} | self._crowded(name, gaining | loose_days)
                # What does not lie in the layout of the table yet.
                rest = [] if whole else [keyed]
                rest += [loose] if loose_days else []
                rest += [kept(self._read_files(name, files - replaced))] if files - replaced else []
                ready = f"{staged}/{_KEYED}=true" if whole else None
                if rest:
                    # Files are named by the job that wrote them: both jobs write into one place.
                    extra = self._stage(name, reduce(DataFrame.unionByName, rest))
                    if whole:
                        self._merge_staged(extra, ready)
                    else:
                        ready = extra
                self._commit(name, batch, touched=touched, replaced_files=files, marks=marks, staged=ready)
        finally:
            for path in aside:
                # What a journal names is moved in by the next access.
                if path != staged or not paths.exists(self.spark, self._journal_path(name)):
                    paths.remove(self.spark, path)
        return touched

    @staticmethod
    def _named(target: DataFrame, day: str, hits: dict[tuple, int]) -> list[tuple]:
        """(day, file, whether every row of it was hit) from the hits per day and checksum of the file's name.

        Of files that share a checksum all are named, none as hit wholly.
        """
        if not hits:
            return []
        counts = target.where(on_dates(day, {d for d, _ in hits})).groupBy(day, "_file").count().collect()  # a row per file
        known: dict[tuple, list] = {}
        for r in counts:
            known.setdefault((r[day], zlib.crc32(r["_file"].encode())), []).append(r)
        return [(d, r["_file"], len(known[d, c]) == 1 and r["count"] == n) for (d, c), n in hits.items() for r in known[d, c]]

    def _merge_staged(self, source: str, target: str) -> None:
        for child in paths.children(self.spark, source):
            for file in paths.files(self.spark, f"{source}/{child}") if "=" in child else ():
                paths.move(self.spark, f"{source}/{child}/{file}", f"{target}/{child}/{file}")
        paths.remove(self.spark, source)

    def _stage_apart(self, name: str, batch: DataFrame, staged: str) -> tuple[DataFrame, DataFrame]:
        """Write the rows with a key in the layout of the table, and beside them those without, in one pass."""
        table = TABLES[name]
        laid = spread(batch.withColumn(_KEYED, has_key(table.keys)), table.date_col, table.cluster, first=_KEYED)
        laid.write.partitionBy(_KEYED, table.date_col).parquet(staged)
        parts = []
        for value in ("true", "false"):
            paths.make(self.spark, f"{staged}/{_KEYED}={value}")
            parts.append(self.spark.read.schema(batch.schema).parquet(f"{staged}/{_KEYED}={value}").select(*batch.columns))
        return parts[0], parts[1]

    @staticmethod
    def _spans(keyed: DataFrame, loose: DataFrame, day: str) -> tuple[int, Days, Days]:
        """How many rows have a key, the days of these, and those of the others."""
        both = keyed.select(day, F.lit(True).alias("keyed")).unionAll(loose.select(day, F.lit(False).alias("keyed")))
        counts = both.groupBy("keyed", day).count().collect()  # two rows per partition date at most
        n_keyed = sum(r["count"] for r in counts if r.keyed)
        return n_keyed, {r[day] for r in counts if r.keyed}, {r[day] for r in counts if not r.keyed}

    def _dates_with(self, name: str, keyed: DataFrame, gaining: Days, n_keyed: int) -> Days:
        """The partitions that may hold keys of the batch.

        More than a few keys fall into every bucket of the index, which then says no more than the keys
        in the table, and these are to be read for the files anyway.
        """
        if TABLES[name].key_fixes_date:
            return gaining
        index = self.index(name)
        if not index.pays(n_keyed):
            return set(self.partitions(name))
        if not index.exists():
            index.build(self.read(name))
        return index.dates(keyed)

    def _lacking(self, target: DataFrame, loose: DataFrame, table: Table) -> DataFrame:
        """Key-less rows that the table does not have yet; equal content means the same partition."""
        days = dates_of(loose, table.date_col)
        if not days:
            return loose
        return missing_copies(target.where(on_dates(table.date_col, days)).where(~has_key(table.keys)), loose).select(loose.columns)

    def _check_bound(self, name: str, keyed: DataFrame, found: DataFrame, days: int) -> None:
        table = TABLES[name]
        new = keyed.select(*table.keys, F.col(table.date_col).alias("_new"))
        beyond = found.join(new, list(table.keys)).where(F.abs(F.date_diff("_new", table.date_col)) > days)
        n = beyond.count()
        if n:
            raise KeyOutOfBounds(f"{name}: {n} keys moved by more than {days} days")

    def _drop_partitions(self, name: str, dates: Iterable[dt.date | None]) -> None:
        for d in dates:
            paths.remove(self.spark, f"{self.path(name)}/{TABLES[name].date_col}={_NO_DATE if d is None else d}")

    def expire(self, name: str, as_of: dt.date) -> list[dt.date]:
        """Drop partitions past the table's retention; returns them.  Rows without a date stay."""
        oldest = as_of - dt.timedelta(days=TABLES[name].retention_days)
        expired = [d for d in self.partitions(name) if d and d < oldest]
        self._drop_partitions(name, expired)
        return expired


def retain(df: DataFrame, date_col: str, days: int, as_of: AsOf) -> DataFrame:
    """Rows still inside the retention period; rows without a date have no age and stay."""
    return df.where((F.col(date_col) >= F.date_sub(as_of_date(as_of), days)) | F.col(date_col).isNull())


def newer_than(df: DataFrame, date_col: str, watermark: dt.date | None, lookback_days: int = 0) -> DataFrame:
    """Incremental slice, with all rows that have no date.  The watermark is a literal, so it prunes partitions."""
    if watermark is None:
        return df
    newer = F.col(date_col) >= F.lit(watermark - dt.timedelta(days=lookback_days))
    return df.where(newer | F.col(date_col).isNull())


def newer_users(df: DataFrame, watermark: dt.date | None, last_update: dt.datetime | None) -> DataFrame:
    """New users, or users changed since the last update seen."""
    if watermark is None:
        return df
    conditions = [F.col("user_date") >= F.lit(watermark)]
    if last_update is not None:
        conditions.append(F.col("updated_at") > F.lit(last_update))
    return df.where(reduce(lambda a, b: a | b, conditions))
