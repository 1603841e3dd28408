"""Column helpers shared by every job.  All of them are built-in, code-generated expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.datetime | dt.date | str


def as_of_ts(as_of: AsOf) -> Column:
    """Run time as a timestamp literal; replaces every "now" so a run can be repeated."""
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_of, dt.time())
    return F.lit(str(as_of)).cast("timestamp")


def as_of_date(as_of: AsOf) -> Column:
    return F.to_date(as_of_ts(as_of))


def blank(c: Column) -> Column:
    """NULL or empty string; never NULL itself."""
    return c.isNull() | (c == "")


def labels(*pairs: tuple[Column, str]) -> Column:
    """Names of the conditions that hold, in the given order; an empty array when none does.

    Not array_compact: it filters by a lambda, which is interpreted for every row and keeps the
    whole projection out of the generated code.
    """
    return F.array_remove(F.array(*[F.when(cond, F.lit(name)).otherwise(F.lit("")) for cond, name in pairs]), "")


def rounded(c: Column, digits: int) -> Column:
    """Round a double half up, the same whatever order its parts were summed in.

    The last-bit noise of a distributed sum would otherwise decide which way 80.475 goes.  So the value is
    moved away from zero by more than that noise (a trillionth of it, at most a hundredth of the last place
    kept) and rounded once: 0.0049999999996 is 0.0 at two places.
    """
    noise = F.least(F.abs(c) * F.lit(1e-12), F.lit(10.0 ** -(digits + 2)))
    return F.round(c + F.signum(c) * noise, digits)


def ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    """a / b as double, NULL when b is 0 or NULL."""
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return q if digits is None else rounded(q, digits)


def ratio_or(a: Column, b: Column, digits: int, default: float) -> Column:
    """Rounded a / b where b > 0, otherwise ``default``."""
    return F.when(b > 0, ratio(a, b, digits)).otherwise(F.lit(default))


def pct(a: Column, b: Column, digits: int = 2) -> Column:
    return ratio(a * F.lit(100.0), b, digits)


def growth(now: Column, before: Column) -> Column:
    """Percent change against an earlier value; NULL when that is NULL or 0."""
    return pct(now - before, before)


def clamp(c: Column, low: int, high: int) -> Column:
    # A NULL score must stay NULL, while least/greatest would skip it.
    return F.when(c.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), c)))


def month_of(d: Column) -> Column:
    return F.trunc(d, "MM")


def sunday_of(d: Column) -> Column:
    """First day of the week, weeks starting on Sunday."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def hours_between(later: Column, earlier: Column) -> Column:
    """Whole hours elapsed, truncated."""
    return F.timestamp_diff("HOUR", earlier, later)


def _flat(payload: Column) -> Column:
    """The payload without its object and array members; members are typed by a variant parse."""
    members = F.from_json(payload, "map<string, variant>")
    scalar = F.map_filter(members, lambda _, v: ~F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    return F.to_json(scalar)


def json_texts(df: DataFrame, payload: str, fields: Iterable[str]) -> DataFrame:
    """Add one string column per top-level JSON field, parsing ``payload`` once per row.

    Only scalars count: objects, arrays, JSON null and malformed text give NULL.  from_json would
    render a nested value as text, so payloads with a further bracket are flattened first.  Doing
    that once per row, and only there, keeps the generated code small enough for the JIT; a type
    test per field made staging three times slower.
    """
    fields = list(fields)
    parsed = "_payload_"
    schema = ", ".join(f"`{f}` string" for f in fields)
    text = F.col(payload)
    nested = F.locate("{", text, 2) + F.locate("[", text, 2) > 0
    document = F.when(nested, _flat(text)).otherwise(text)
    return (
        df.withColumn(parsed, F.from_json(document, schema))
        .withColumns({f: F.col(f"{parsed}.{f}") for f in fields})
        .drop(parsed)
    )
