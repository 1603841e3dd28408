"""Carried window state: what the rolling features of the next days need of all earlier ones.

Per user the last 29 rows and the lifetime sums of everything before them.  A new day reads this state
and the rows behind it, never an older partition.  The state is kept as versions: a run adds the
users it touched, the newest version of a user counts, and after MAX_VERSIONS the versions are
written as one.  ``upto`` is the last day that is in it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventloom.operators.keyed import content_of, with_keys_of, without_keys_of
from eventloom.sources import paths
from eventloom.sources.lake import Lake, on_dates

CARRIED = 29  # rows that the longest window looks back
MAX_VERSIONS = 8
# The measures that windows look at.
MEASURES = (
    "total_events", "total_purchases", "total_sessions", "total_revenue", "page_views", "signups", "logins",
    "web_events", "mobile_events", "unique_products_viewed", "unique_categories_viewed",
)
EVER = {"total_events": "_ever_events", "total_purchases": "_ever_purchases", "total_revenue": "_ever_revenue"}


def state_of(rows: DataFrame) -> DataFrame:
    """The state behind ``rows`` (user_id, date, measures, lifetime inputs): one exchange by user."""
    newest = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("date")))
    kept = F.col("_newest") <= CARRIED
    return rows.withColumn("_newest", newest).groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.when(kept, F.struct("date", *MEASURES)))).alias("rows"),
        # What precedes the carried rows, including what preceded these.
        *[F.sum(F.when(kept, F.col(ever) - F.col(c)).otherwise(F.col(ever))).alias(ever) for c, ever in EVER.items()],
    )


def with_ever(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({ever: F.col(c) for c, ever in EVER.items()})


def rows_behind(state: DataFrame, metrics: DataFrame) -> DataFrame:
    """The carried rows before the rows of ``metrics``: windows over both are windows over all rows.

    The first carried row of a user brings the lifetime sums of what came before it.
    """
    carried = state.select("user_id", *EVER.values(), F.posexplode("rows").alias("_at", "_row"))
    first = F.col("_at") == 0
    before = {e: F.col(f"_row.{c}") + F.when(first, F.col(e)).otherwise(F.lit(0)) for c, e in EVER.items()}
    carried = carried.select("user_id", "_row.*", *[c.alias(e) for e, c in before.items()])
    return with_ever(metrics).unionByName(carried, allowMissingColumns=True)


class CarriedState:
    def __init__(self, lake: Lake):
        self.lake, self.spark = lake, lake.spark
        self.where = f"{lake.root}/_state/user_windows"

    def _meta(self) -> dict | None:
        path = f"{self.where}/meta.json"
        return json.loads(paths.read_text(self.spark, path)) if paths.exists(self.spark, path) else None

    @property
    def upto(self) -> dt.date | None:
        meta = self._meta()
        return dt.date.fromisoformat(meta["upto"]) if meta and meta["upto"] else None

    def _write(self, state: DataFrame, versions: list[str], upto: dt.date | None) -> None:
        name = uuid.uuid4().hex[:12]
        state.write.parquet(f"{self.where}/{name}")
        meta = {"versions": [*versions, name], "upto": upto and upto.isoformat(), "schema": state.schema.json()}
        paths.write_text(self.spark, f"{self.where}/meta.json", json.dumps(meta))

    def read(self, users: DataFrame | None = None) -> DataFrame:
        """The newest version of every user, or of those named."""
        meta, parts = self._meta(), None
        schema = StructType.fromJson(json.loads(meta["schema"]))
        for n, version in enumerate(meta["versions"]):
            df = self.spark.read.schema(schema).parquet(f"{self.where}/{version}").withColumn("_version", F.lit(n))
            parts = df if parts is None else parts.unionAll(df)
        if users is not None:
            parts = with_keys_of(parts, users, ["user_id"])
        if len(meta["versions"]) == 1:
            return parts.drop("_version")
        columns = [c for c in parts.columns if c != "_version"]
        return parts.groupBy("user_id").agg(F.max_by(F.struct(*columns), "_version").alias("_s")).select("_s.*")

    def rebuild(self, metrics: DataFrame, upto: dt.date | None) -> None:
        old = self._meta()
        self._write(state_of(with_ever(metrics)), [], upto)
        self._clear(old)

    def advance(self, state: DataFrame, gone: DataFrame | None, upto: dt.date | None) -> None:
        """Add the new state of some users; users in ``gone`` have no rows left."""
        meta = self._meta()
        if gone is None and len(meta["versions"]) < MAX_VERSIONS:
            self._write(state, meta["versions"], upto)
            return
        whole = without_keys_of(self.read(), state, ["user_id"]).unionByName(state)
        self._write(whole if gone is None else without_keys_of(whole, gone, ["user_id"]), [], upto)
        self._clear(meta)

    def _clear(self, meta: dict | None) -> None:
        for version in meta["versions"] if meta else ():
            paths.remove(self.spark, f"{self.where}/{version}")

    # --- changed rows behind the state --------------------------------------------------------

    @property
    def _dirty(self) -> str:
        return f"{self.lake.root}/_state/changed_user_days"

    def note(self, old: DataFrame, new: DataFrame) -> None:
        """Remember which rows of days in the state differ between two versions, until all have caught up."""
        content = content_of(new)
        one = [x.select("user_id", "date", *[c.alias(n) for n, c in content_of(x).items()]) for x in (old.select(new.columns), new)]
        both = one[0].withColumn("_n", F.lit(1)).unionAll(one[1].withColumn("_n", F.lit(-1)))
        changed = both.groupBy("user_id", "date", *content).agg(F.sum("_n").alias("_n")).where("_n <> 0")
        changed.select("user_id", "date").distinct().write.mode("append").parquet(self._dirty)

    def changed_users(self, days: Iterable[dt.date]) -> DataFrame:
        """Users with a row of one of these days that has changed, come or gone."""
        rows = self.spark.read.schema("user_id string, date date").parquet(self._dirty) if paths.exists(self.spark, self._dirty) else self.spark.createDataFrame([], "user_id string, date date")
        return rows.where(on_dates("date", days)).select("user_id").distinct()

    def forget(self) -> None:
        paths.remove(self.spark, self._dirty)


class Slice:
    """The user days that a model has to take over, with what windows over them need.

    Days behind the state come from it and the rows since: no older partition is read.  Late days
    concern the users whose rows changed, and only these users' history is read.
    """

    def __init__(self, state: CarriedState, metrics: DataFrame, days: set[dt.date], usable: bool):
        upto = state.upto if usable else None
        self.state, self.metrics, self.upto = state, metrics, upto
        self.new = {d for d in days if upto and d > upto}
        self.late = days - self.new
        self.affected = None
        if self.late:
            active = metrics.where(on_dates("date", self.late)).select("user_id").distinct()
            self.affected = state.lake.materialise(state.changed_users(self.late) if usable else active, "affected-users")

    def history(self) -> DataFrame:
        """All rows of the users that late days concern."""
        return with_keys_of(self.metrics, self.affected, ["user_id"])

    def following(self) -> DataFrame:
        """The rows behind the state of all other users, and before them what the state carries."""
        tail = self.metrics.where(F.col("date") > F.lit(self.upto))
        if self.affected is not None:
            tail = without_keys_of(tail, self.affected, ["user_id"])
        return rows_behind(self.state.read(tail), tail)

    def rows(self, model: Callable[[DataFrame], DataFrame], day: str) -> tuple[DataFrame | None, DataFrame | None]:
        """(rows of new days, complete; rows of late days, of the users concerned) by a model of user days."""
        behind = F.col(day) >= F.lit(min(self.new)) if self.new else F.lit(False)
        late = model(self.history()).where(F.col(day) >= F.lit(min(self.late))) if self.late else None
        if late is not None:  # both parts of it are stored, the earlier one from several looks
            late = self.state.lake.materialise(late, "late-days")
        fresh = model(self.following()).where(behind) if self.new else None
        if late is None or fresh is None:
            return fresh, late
        return fresh.unionByName(late.where(behind)), late.where(~behind)
