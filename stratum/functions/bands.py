"""Bands, flags, lookups and scores."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def band(
    column: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    closed: str = "left",
    null_label: str | None = None,
) -> Column:
    """Label a number by ascending ``edges``; ``len(labels) == len(edges) + 1``.

    ``closed="left"`` compares with ``<`` (an edge value falls in the upper band), ``"right"`` with ``<=``.
    Null gets ``null_label``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    c = _c(column)
    out = F.when(c.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        out = out.when(c < edge if closed == "left" else c <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def map_lookup(column: Column | str, mapping: Mapping[str, object], default: Column | object = None) -> Column:
    """Constant lookup; a miss (or a null key) gives ``default``."""
    c = _c(column)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(table, c), fallback)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def score(conditions: Iterable[Column]) -> Column:
    """How many conditions hold; unknown counts as no."""
    return reduce(lambda a, b: a + b, [F.coalesce(c.cast("int"), F.lit(0)) for c in conditions])


def present(columns: Iterable[str]) -> list[Column]:
    return [F.col(c).isNotNull() for c in columns]


def fill_when(column: str, applies: Column, filler: object) -> Column:
    """Fill nulls of ``column`` only on the rows where ``applies`` holds."""
    return F.when(applies & F.col(column).isNull(), F.lit(filler)).otherwise(F.col(column))


def full_years(start: Column | str, end: Column) -> Column:
    """Completed years between two dates."""
    return F.floor(F.months_between(end, _c(start)) / 12).cast("int")


def years_by_days(start: Column | str, end: Column) -> Column:
    """Age in years on the 365.25-day convention."""
    return F.floor(F.datediff(end, _c(start)) / 365.25).cast("int")
