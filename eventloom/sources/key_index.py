"""Where the keys of a date-partitioned table are: key -> partition date, laid out by the hash of the key.

An upsert asks for the dates of its keys and reads the buckets these fall into, not the key column of
the table.  Entries are only ever appended, each commit of the table adding those of the rows it
writes before they appear there.  An entry may therefore be out of date, which costs a look into a
partition that no longer holds the key; a row without an entry cannot exist.  After MAX_APPENDS commits
the entries are rewritten once each.  It serves small batches and is built by the first one: the keys of
a large one fall into every bucket.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.keyed import has_key, with_keys_of
from eventloom.sources import paths
from eventloom.sources.catalog import Table

BUCKET_KEYS = 2_000_000
MAX_APPENDS = 64
FEW_KEYS = 64
_BUCKET = "_bucket"


class KeyIndex:
    def __init__(self, spark: SparkSession, root: str, table: Table):
        self.spark, self.table = spark, table
        self.where = f"{root}/_index/{table.name}"

    def _meta(self) -> dict | None:
        path = f"{self.where}/meta.json"
        return json.loads(paths.read_text(self.spark, path)) if paths.exists(self.spark, path) else None

    def _set_meta(self, meta: dict) -> None:
        paths.write_text(self.spark, f"{self.where}/meta.json", json.dumps(meta))

    def exists(self) -> bool:
        return self._meta() is not None

    def pays(self, n_keys: int) -> bool:
        """Whether a batch of so many keys may leave buckets unread."""
        meta = self._meta()
        return n_keys <= max(FEW_KEYS, meta["buckets"] if meta else 0)

    def drop(self) -> None:
        paths.remove(self.spark, self.where)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.table.keys]), F.lit(buckets)).cast("int")

    def _append(self, rows: DataFrame, meta: dict) -> None:
        columns = [*self.table.keys, self.table.date_col]
        # A key that repeats is only an entry more.
        placed = rows.where(has_key(self.table.keys)).select(*columns).withColumn(_BUCKET, self._bucket(meta["buckets"]))
        laid = placed.hint("rebalance", F.col(_BUCKET)).sortWithinPartitions(_BUCKET, *self.table.keys)
        laid.write.mode("append").partitionBy(_BUCKET).parquet(f"{self.where}/{meta['version']}")

    def build(self, rows: DataFrame) -> None:
        """The entries of a whole table; an index that exists is replaced."""
        old = self._meta()
        types = {f.name: f.dataType.simpleString() for f in rows.select(*self.table.keys, self.table.date_col).schema}
        meta = {"version": uuid.uuid4().hex[:12], "buckets": max(1, -(-rows.count() // BUCKET_KEYS)), "appends": 0, "types": types}
        self._append(rows, meta)
        self._set_meta(meta)
        if old:
            paths.remove(self.spark, f"{self.where}/{old['version']}")

    def add(self, rows: DataFrame) -> None:
        """The entries of rows about to be stored."""
        meta = self._meta()
        if meta["appends"] >= MAX_APPENDS:
            self.build(self.entries().select(*self.table.keys, self.table.date_col).distinct())
            meta = self._meta()
        self._append(rows, meta)
        self._set_meta({**meta, "appends": meta["appends"] + 1})

    def entries(self, buckets: set[int] | None = None) -> DataFrame:
        meta = self._meta()
        schema = ", ".join(f"`{c}` {t}" for c, t in {**meta["types"], _BUCKET: "int"}.items())
        df = self.spark.read.schema(schema).parquet(f"{self.where}/{meta['version']}")
        return df if buckets is None else df.where(F.col(_BUCKET).isin(sorted(buckets)))

    def matches(self, keyed: DataFrame) -> DataFrame:
        """The entries of the keys of ``keyed``, from their buckets alone."""
        meta = self._meta()
        touched = {r[0] for r in keyed.select(self._bucket(meta["buckets"])).distinct().collect()}  # a bucket each at most
        return with_keys_of(self.entries(None if len(touched) == meta["buckets"] else touched), keyed, self.table.keys)

    def dates(self, keyed: DataFrame) -> set[dt.date | None]:
        """The partition dates that may hold keys of ``keyed``."""
        return {r[0] for r in self.matches(keyed).select(self.table.date_col).distinct().collect()}
