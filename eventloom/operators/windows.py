"""Trailing windows per entity.

All frames of one call share PARTITION BY / ORDER BY, so they cost one exchange and one sort.
Inputs are already daily, which bounds a partition by the number of days, however many events
one entity produced.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

ROWS = "rows"
CALENDAR = "calendar"
_EPOCH = "1970-01-01"


def trailing(entity: str | None, day: str, length: int, mode: str = ROWS) -> WindowSpec:
    """The current row and what precedes it: the last ``length`` rows, or the last ``length`` days.

    Row counting is the default and means "active days"; calendar mode means real days.
    With ``entity=None`` the window is global, meant for one-row-per-day inputs only.
    """
    base = Window.partitionBy(entity) if entity else Window.partitionBy()
    if mode == ROWS:
        return base.orderBy(day).rowsBetween(-(length - 1), 0)
    if mode == CALENDAR:
        number = F.datediff(F.col(day), F.lit(_EPOCH).cast("date"))
        return base.orderBy(number).rangeBetween(-(length - 1), 0)
    raise ValueError(f"unknown window mode {mode!r}")


def following(entity: str, day: str, length: int) -> WindowSpec:
    """The ``length`` calendar days after the current row's day, the day itself excluded."""
    number = F.datediff(F.col(day), F.lit(_EPOCH).cast("date"))
    return Window.partitionBy(entity).orderBy(number).rangeBetween(1, length)


def lifetime(entity: str, day: str) -> WindowSpec:
    return Window.partitionBy(entity).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)


def previous(column: str, entity: str | None, day: str) -> Column:
    base = Window.partitionBy(entity) if entity else Window.partitionBy()
    return F.lag(column).over(base.orderBy(day))


def sums(over: WindowSpec, **columns: str) -> dict[str, Column]:
    """{output name: sum(input column) over the window}"""
    return {out: F.sum(src).over(over) for out, src in columns.items()}
