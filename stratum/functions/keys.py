"""Surrogate keys, date keys and reproducible aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def surrogate(*columns: Column | str, record_type: str | None = None) -> Column:
    """64-bit key. ``xxhash64`` skips nulls, so a record-type literal keeps key families apart."""
    parts = [_c(c) for c in columns]
    if record_type is not None:
        parts.append(F.lit(record_type))
    return F.xxhash64(*parts)


def version_key(key: Column | str, start: Column | str) -> Column:
    """SHA-256 of ``key|start``, the key of one version of a dimension row."""
    return F.sha2(F.concat(_c(key).cast("string"), F.lit("|"), _c(start).cast("string")), 256)


def date_key(column: Column | str) -> Column:
    """Integer ``yyyyMMdd``."""
    c = _c(column)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def steady_sum(column: Column | str, digits: int = 2) -> Column:
    """Sum of amounts rounded to their own precision, so it does not depend on the order of addition."""
    return F.round(F.sum(_c(column)), digits)


def steady_avg(column: Column | str, digits: int = 2) -> Column:
    """Mean built on :func:`steady_sum`; the same on every partitioning."""
    return steady_sum(column, digits) / F.count(_c(column))
