"""Group facts attached to detail rows.

Aggregate-then-join instead of a window: the aggregate combines map-side and AQE splits a hot key in the
join, while a window would pull the whole group into one task. The aggregate is written first, so the join is planned
on its true size: Spark broadcasts it below its threshold and the detail is not shuffled at all, beyond it both sides are
shuffled and hot keys are split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable


def join_on(left: Sequence[str], right: Sequence[str], null_safe: bool = False) -> Column:
    """Equality of two lists of (distinctly named) columns."""
    pairs = [
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in zip(left, right)
    ]
    return reduce(lambda a, b: a & b, pairs)


def splittable(left: Sequence[str], right: Sequence[str], tag: str) -> Column:
    """Equality of two key lists in a form whose hot partitions AQE can split.

    AQE splits a join only if both inputs come straight from a shuffle made for it and no later step relies on
    its partitioning. An aggregate, distinct or window on the same key would hand its partitioning to the join
    and switch that off. The second condition is always true, but makes the join ask for a partitioning of its
    own; the price is one more shuffle of the (narrow, one row per key) right side. ``tag`` names the join, so
    that two joins on one key do not share a partitioning either.
    """
    def anchor(keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(tag)), F.lit(1))

    return join_on(left, right) & (anchor(left) == anchor(right))


def with_group(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    where: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Attach ``aggregates`` of the key's group (restricted to ``where``) to every row.

    The row count does not change. A null key matches its own group only when ``null_safe``.
    """
    members = df if where is None else df.filter(where)
    side_keys = [f"__g{i}" for i in range(len(keys))]
    side = durable(members.groupBy(*[F.col(k).alias(s) for k, s in zip(keys, side_keys)]).agg(
        *[a.alias(n) for n, a in aggregates.items()]
    ), "groups")
    on = join_on(keys, side_keys, null_safe=True) if null_safe else splittable(keys, side_keys, ",".join(aggregates))
    return df.join(side, on, "left").drop(*side_keys)


def with_group_count(
    df: DataFrame, keys: Sequence[str], name: str, where: Column | None = None, null_safe: bool = False
) -> DataFrame:
    """Attach the size of the key's group."""
    return with_group(df, keys, {name: F.count(F.lit(1))}, where, null_safe)
