"""Many-to-many bridges from JSON arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_items(column: Column | str) -> Column:
    """A JSON array that is neither null nor empty."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & ~c.isin("[]", "null")


def explode_json(df: DataFrame, column: str, schema: str, keep: Sequence[str]) -> DataFrame:
    """One row per array element; empty, null and malformed arrays give none.

    ``keep`` columns that share a name with a field are taken from the field.
    """
    fields = df.filter(has_items(column)).select(
        *keep, F.explode(F.from_json(column, schema)).alias("__item")
    )
    names = fields.schema["__item"].dataType.names
    return fields.select("__item.*", *[c for c in keep if c not in names])


def malformed_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """One row: how many populated arrays do not parse."""
    return df.agg(F.count_if(has_items(column) & F.from_json(column, schema).isNull()).alias("malformed"))


def primary_holder(bridge: DataFrame, group: str, role: str, primary: str, order: Sequence[str]) -> DataFrame:
    """Exactly one primary row per group, chosen by ``order``; the rest is reported by the bridge checks."""
    from .dedup import latest_by

    return latest_by(bridge.filter(F.col(role) == primary), [group], [F.col(c).asc_nulls_last() for c in order])
