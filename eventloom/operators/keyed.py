"""Unique-key helpers behind the incremental upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[k] for k in keys])


# Columns that say when a row was processed, not what it says.
STAMPS = ("processed_at", "last_updated")


def has_key(keys: Sequence[str]) -> Column:
    """Neither NULL nor blank: such rows cannot be told apart by their key."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys])


def content_of(df: DataFrame) -> dict[str, Column]:
    """Two hashes of what a row says: its columns by name without the stamps; a NULL column says nothing,
    so a column added later does not make old rows new."""
    said = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns) if c not in STAMPS]))
    return {f"_content{seed}": F.xxhash64(F.lit(seed), said) for seed in (1, 2)}


def missing_copies(have: DataFrame, want: DataFrame) -> DataFrame:
    """The rows of ``want`` that ``have`` lacks, counted per copy, by content without the stamps.

    Rows without a key are matched like this: a replay adds nothing, and equal rows that were
    delivered twice in one batch stay two.  Copies are counted, so many of one kind are no hot group.
    """
    names = sorted(c for c in want.columns if c not in STAMPS)
    flagged = [x for c in names for x in (F.col(c).isNull(), F.col(c))]
    content = {f"_content{seed}": F.xxhash64(F.lit(seed), *flagged) for seed in (1, 2)}
    there = have.withColumns(content).groupBy(*content).agg(F.count("*").alias("_have"))
    here = want.withColumns(content).groupBy(*content).agg(F.count("*").alias("_want"), F.first(F.struct(*want.columns)).alias("_row"))
    extra = (F.col("_want") - F.coalesce("_have", F.lit(0))).cast("int")
    lacking = here.join(there, list(content), "left").where(extra > 0)
    return lacking.select(F.explode(F.array_repeat("_row", extra)).alias("_row")).select("_row.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key: the newest one.  Rows whose key has a NULL or blank part are all kept.

    The ``= 1`` filter becomes a WindowGroupLimit below the exchange, so a key with very many
    copies sends one row per map task, not all of them.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    # Last resort for full ties, so that a re-run keeps the same row.
    order.append(F.xxhash64(*df.columns).desc())
    w = Window.partitionBy(*keys).orderBy(*order)
    unique = df.where(has_key(keys)).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return unique.unionByName(df.where(~has_key(keys)))


def repeats_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key may occur twice: only hashes are dealt, not rows.  A collision counts as a repetition."""
    hashed = df.where(has_key(keys)).select(F.xxhash64(*keys).alias("_key"))
    return not hashed.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").isEmpty()


def without_keys_of(df: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(batch.select(*keys), list(keys), "left_anti")


def with_keys_of(df: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(batch.select(*keys).distinct(), list(keys), "left_semi")


def sync_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with exactly the columns and types of ``new``: added ones NULL, removed ones dropped."""
    types = dict(new.dtypes)
    return old.select(
        *[
            (F.col(c) if c in old.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in new.columns
        ]
    )
