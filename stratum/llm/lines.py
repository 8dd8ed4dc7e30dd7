"""Places and running sums in a global order, without a task that sees a whole group.

Rows are range partitioned by (group, order) and written, so that partition numbers are fixed even if executors are
lost afterwards. A place is then the place inside the partition plus what the group has in earlier partitions, and
only one row per group and partition is summed up for that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled


def in_line(rows: DataFrame, group: list[str], order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """``rows`` with ``place`` (from 0 in its group), ``members`` (rows of the group) and, if ``weight`` names a column,
    ``before`` (its sum over the group's earlier rows) and ``total`` (over all of them).

    Ascending order, nulls first, a null group is a group; rows equal in ``order`` get neighbouring places. A bulk of
    rows that are equal in ``order`` shares a partition: give ``order`` a last column that tells rows apart.
    """
    keys = [*group, *order]
    line = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    line = settled(line.withColumn("part", F.shiftright("at", 33)), name)
    amount = F.col(weight).cast("long") if weight else F.lit(0).cast("long")
    parts = line.groupBy(*group, "part").agg(
        F.min("at").alias("first_at"), F.count(F.lit(1)).alias("part_rows"), F.sum(amount).alias("part_sum"),
    )
    whole = Window.partitionBy(*[F.col(c) for c in group], F.lit(0)) if group else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    parts = parts.select(
        *[F.col(c).alias(f"of_{c}") for c in group], F.col("part").alias("of_part"), "first_at",
        F.coalesce(F.sum("part_rows").over(earlier), none).alias("rows_before"),
        F.coalesce(F.sum("part_sum").over(earlier), none).alias("sum_before"),
        F.sum("part_rows").over(whole).alias("members"), F.sum("part_sum").over(whole).alias("total"),
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in group], F.col("part") == F.col("of_part"))
    found = line.join(parts, same).withColumn("place", F.col("rows_before") + F.col("at") - F.col("first_at"))
    added = ["place", "members"]
    if weight:
        inside = Window.partitionBy("part", *group).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("before", F.col("sum_before") + F.coalesce(F.sum(amount).over(inside), none))
        added += ["before", "total"]
    return found.select(*rows.columns, *added)
