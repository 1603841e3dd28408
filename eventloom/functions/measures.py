"""Aggregates over staged events that several daily models share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.expressions import ratio


def is_type(*types: str) -> Column:
    c = F.col("event_type")
    return c == types[0] if len(types) == 1 else c.isin(*types)


def hits(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def distinct(column: str) -> Column:
    return F.count_distinct(column)


def purchase_amount() -> Column:
    """Amount of a purchase, NULL on every other row; avg/min/max skip those."""
    return F.when(is_type("purchase"), F.col("amount"))


def revenue(currency: str | None = None) -> Column:
    money = purchase_amount()
    if currency:
        money = F.when(F.col("currency") == currency, money)
    return F.sum(F.coalesce(money, F.lit(0.0)))


def missing(column: str, *types: str) -> Column:
    """Rows of these types without a value in ``column``."""
    return F.count_if(F.col(column).isNull() & is_type(*types))


def events_per(column: str) -> Column:
    return ratio(F.count(F.lit(1)), F.count_distinct(column), 2)


def rows() -> Column:
    return F.count(F.lit(1))
