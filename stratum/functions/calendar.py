"""Calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def weekday(column: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_c(column)) + 1


def monday_week(column: Column | str) -> Column:
    """Week of the year counted from the first Monday (0-53), unlike the ISO week."""
    c = _c(column)
    return F.floor((F.dayofyear(c) + 6 - F.weekday(c)) / 7).cast("int")


def month_index(column: Column | str) -> Column:
    """Months since year 0, so consecutive months differ by one."""
    c = _c(column)
    return F.year(c) * 12 + F.month(c)
