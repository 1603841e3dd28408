"""Generic data-quality checks.  Each takes a table and returns rows; nothing is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.expressions import as_of_ts, hours_between, pct
from eventloom.operators.windows import trailing
from eventloom.functions.measures import rows


def unpivot_row(df: DataFrame, entries: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn each row into one output row per entry (column name -> value)."""
    return df.select(F.inline(F.array(*[F.struct(*[v.alias(k) for k, v in e.items()]) for e in entries])))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(rows().alias("n_rows")).where("n_rows > 1")


def not_null_proportion(df: DataFrame, columns: Sequence[str], at_least: float) -> DataFrame:
    """Share of non-NULL values per column, all columns in one pass."""
    shares = df.agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in columns])
    return unpivot_row(
        shares,
        [
            {
                "column_name": F.lit(c),
                "proportion": F.col(c),
                "passed": F.coalesce(F.col(c) >= at_least, F.lit(True)),
            }
            for c in columns
        ],
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list and how often they occur; NULL passes."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(rows().alias("n_rows"))
        .select(F.lit(column).alias("column_name"), "value", "n_rows")
    )


def failures_of(conditions: Mapping[str, Column]) -> list[Column]:
    """One aggregate per condition: rows where it is false.  NULL passes."""
    return [F.count_if(~c).alias(name) for name, c in conditions.items()]


def expressions_true(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Failing rows per condition; every condition is evaluated in the same scan."""
    names = {f"c{i}": text for i, text in enumerate(conditions)}
    counted = df.agg(*failures_of(dict(zip(names, conditions.values()))))
    return unpivot_row(counted, [{"expression": F.lit(t), "failed_rows": F.col(c)} for c, t in names.items()])


def unique_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows failing the two single-column tests: surplus copies groups and NULLs."""
    per_value = df.groupBy(column).agg(rows().alias("n"))
    counted = per_value.agg(
        F.count_if((F.col("n") > 1) & F.col(column).isNotNull()).alias("unique"),
        F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0)).alias("not_null"),
    )
    return unpivot_row(
        counted,
        [
            {"column_name": F.lit(column), "test_name": F.lit(t), "failed_rows": F.col(t)}
            for t in ("unique", "not_null")
        ],
    )


def null_profile(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL counts and percentages of the critical columns, one scan."""
    present = [c for c in columns if c in df.columns]
    counted = df.agg(rows().alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present])
    return unpivot_row(
        counted,
        [
            {
                "table_name": F.lit(table),
                "column_name": F.lit(c),
                "total_rows": F.col("n"),
                "null_count": F.col(f"null_{c}"),
                "null_percentage": pct(F.col(f"null_{c}"), F.col("n")),
            }
            for c in present
        ],
    )


def duplicate_rows(df: DataFrame, table: str) -> DataFrame:
    """Whole-row duplicates.  Grouping treats NULLs as equal, count(distinct *) would skip them.

    Shuffled are two hashes per row; whole rows only where both are shared, so that a collision is told
    from a copy.
    """
    kinds = dict(df.dtypes)
    # Grouping takes -0.0 for 0.0, the hash would not.
    said = [F.col(c) + F.lit(0.0).cast(kinds[c]) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns]
    flags = [F.col(c).isNull() for c in df.columns]
    hashes = {f"_hash{seed}": F.xxhash64(F.lit(seed), *said, *flags) for seed in (1, 2)}
    groups = df.select(*[h.alias(n) for n, h in hashes.items()]).groupBy(*hashes).agg(rows().alias("n"))
    shared = df.withColumns(hashes).join(groups.where("n > 1").select(*hashes), list(hashes), "left_semi")
    copies = shared.groupBy(*hashes, *df.columns).agg(rows().alias("n")).select("n")
    return groups.where("n = 1").select("n").unionAll(copies).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("n").alias("unique_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
    ).select(F.lit(table).alias("table_name"), "total_rows", "unique_rows", "duplicate_count")


def freshness(df: DataFrame, table: str, column: str, as_of, max_hours: float = 4) -> DataFrame:
    """Hours since the newest value; an empty table is an error."""
    newest = df.agg(F.max(F.col(column).cast("timestamp")).alias("latest"))
    hours = hours_between(as_of_ts(as_of), F.col("latest"))
    status = F.when(hours.isNull(), "error").when(hours > max_hours, "warning").otherwise("success")
    return newest.select(
        F.lit(table).alias("table_name"), "latest", hours.alias("hours_behind"), status.alias("status")
    )


def layer_sla(df: DataFrame, layer: str, table: str, column: str, as_of, max_minutes: int) -> DataFrame:
    newest = df.agg(F.max(F.col(column).cast("timestamp")).alias("latest"))
    minutes = F.timestamp_diff("MINUTE", F.col("latest"), as_of_ts(as_of))
    return newest.select(
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        minutes.alias("minutes_behind"),
        F.lit(max_minutes).alias("max_minutes"),
        (F.coalesce(minutes <= max_minutes, F.lit(False))).alias("within_sla"),
    )


def volume_anomalies(df: DataFrame, day: str, threshold: float = 3.0, history: int = 7) -> DataFrame:
    """Daily row counts with their z-score against the ``history`` days before.

    Every day from the first to the last counts, a day without rows with 0.  After days that were
    all alike any other count is an anomaly.  Rows without a date are on no day.  The global window
    sees one row per day, never the table's rows.
    """
    counted = df.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("date")).agg(rows().alias("n"))
    span = counted.agg(F.min("date").alias("first"), F.max("date").alias("last")).where("first IS NOT NULL")
    calendar = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    daily = calendar.join(counted, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n_rows"))
    before = trailing(None, "date", 1).rowsBetween(-history, -1)
    mean, spread = F.avg("n_rows").over(before), F.stddev_samp("n_rows").over(before)
    scored = daily.select(
        "date",
        "n_rows",
        mean.alias("expected"),
        F.try_divide(F.col("n_rows") - mean, spread).alias("z_score"),
        (spread == 0).alias("_steady"),
    )
    odd = F.when(F.col("_steady"), F.col("n_rows") != F.col("expected")).otherwise(F.abs("z_score") > threshold)
    return scored.withColumn("is_anomaly", F.coalesce(odd, F.lit(False))).drop("_steady")


def schema_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Added, removed and retyped columns plus the change in row count between two versions."""
    before, after = dict(old.dtypes), dict(new.dtypes)
    found = [(c, "removed", before[c], None) for c in before if c not in after]
    found += [(c, "added", None, after[c]) for c in after if c not in before]
    found += [(c, "retyped", before[c], after[c]) for c in after if before.get(c, after[c]) != after[c]]
    counts = old.agg(rows().alias("old_rows")).select(
        "old_rows", new.agg(rows()).scalar().alias("new_rows")
    ).select(
        F.lit("*").alias("column_name"),
        F.when(F.col("old_rows") == F.col("new_rows"), "same_rows").otherwise("row_count").alias("change"),
        F.col("old_rows").cast("string").alias("old_type"),
        F.col("new_rows").cast("string").alias("new_type"),
    )
    if not found:
        return counts
    schema = "column_name string, change string, old_type string, new_type string"
    return counts.unionByName(old.sparkSession.createDataFrame(found, schema))
