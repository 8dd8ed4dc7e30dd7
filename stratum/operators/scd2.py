"""Type-2 slowly changing dimension and the point-in-time join against it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import OPEN_END
from ..functions.keys import version_key
from .groups import splittable
from .upsert import null_spread

FROM, TO, CURRENT = "effective_from", "effective_to", "is_current"


def _date(value: dt.date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def scd2_init(df: DataFrame, key: str, from_col: str, key_name: str = "dim_key") -> DataFrame:
    """First load: every row is the open version, valid from its own ``from_col``."""
    start = F.col(from_col).cast("date")
    return df.select(
        version_key(key, start).alias(key_name), key, start.alias(FROM), _date(OPEN_END).alias(TO),
        F.lit(True).alias(CURRENT), *[c for c in df.columns if c != key],
    )


def scd2_apply(
    dim: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: dt.date | str | Column,
    key_name: str = "dim_key",
) -> DataFrame:
    """The dimension after one snapshot of ``incoming`` seen on ``as_of``.

    A row whose tracked columns differ (null-safe) closes the open version the day before and opens a new
    one; a second change on the same day replaces the version opened that day. New keys open a version,
    everything else passes through unchanged. Closed versions skip the join entirely.
    """
    day = _date(as_of)
    payload = [c for c in dim.columns if c not in (key_name, key, FROM, TO, CURRENT)]
    closed = dim.filter(~F.col(CURRENT))
    old = dim.filter(F.col(CURRENT)).select(
        F.struct(*dim.columns).alias("o"), F.col(key).alias("__ok"), null_spread([key], dim.columns, 0).alias("__on")
    )
    new = incoming.select(
        F.struct(*incoming.columns).alias("n"), F.col(key).alias("__nk"),
        null_spread([key], incoming.columns, 1).alias("__nn"),
    )
    changed = reduce(lambda a, b: a | b, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in tracked])
    both = F.col("o").isNotNull() & F.col("n").isNotNull()
    steps = (
        F.when(F.col("o").isNull(), F.array(F.lit("open")))
        .when(~both | ~changed, F.array(F.lit("keep")))
        .when(F.col(f"o.{FROM}") >= day, F.array(F.lit("replace")))
        .otherwise(F.array(F.lit("expire"), F.lit("open")))
    )
    on = (F.col("__ok") == F.col("__nk")) & (F.col("__on") == F.col("__nn"))
    live = old.join(new, on, "full_outer").select("o", "n", F.explode(steps).alias("step"))

    step, fresh = F.col("step"), F.col("step").isin("open", "replace")
    have = set(incoming.columns)
    value = {
        **{c: F.when(fresh, F.col(f"n.{c}") if c in have else F.lit(None)).otherwise(F.col(f"o.{c}")) for c in payload},
        key: F.when(fresh, F.col(f"n.{key}")).otherwise(F.col(f"o.{key}")),
        key_name: F.when(step == "open", version_key(F.col(f"n.{key}"), day)).otherwise(F.col(f"o.{key_name}")),
        FROM: F.when(step == "open", day).otherwise(F.col(f"o.{FROM}")),
        TO: F.when(fresh, _date(OPEN_END)).when(step == "expire", F.date_sub(day, 1)).otherwise(F.col(f"o.{TO}")),
        CURRENT: step != "expire",
    }
    return closed.unionByName(live.select(*[value[c].cast(dim.schema[c].dataType).alias(c) for c in dim.columns]))


def version_changes(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Keys of ``incoming`` that are new or differ from their open version; only keys and tracked columns are read."""
    live = dim.filter(F.col(CURRENT)).select(F.col(key).alias("__ok"), *[F.col(c).alias(f"__o_{c}") for c in tracked])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__o_{c}")) for c in tracked])
    return incoming.select(key, *[c for c in tracked if c != key]).join(live, (F.col(key) == F.col("__ok")) & same, "left_anti").select(key)


def scd2_from_events(
    events: DataFrame, key: str, at: str, chunk: Column, tiebreak: Sequence[str] = (), key_name: str = "dim_key"
) -> DataFrame:
    """Versions from a log of changes: each event is valid until the day before the next one.

    The last event of a day wins. ``chunk`` follows the contract of :func:`ranking.with_neighbours`.
    """
    from .dedup import latest_by
    from .ranking import with_neighbours

    daily = latest_by(
        events.withColumn(FROM, F.col(at).cast("date")), [key, FROM],
        [F.col(at).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak]],
    )
    ranged = with_neighbours(daily, [key], [FROM], chunk, leads={"__next": FROM})
    return ranged.select(
        version_key(key, FROM).alias(key_name), key, FROM,
        F.coalesce(F.date_sub("__next", 1), _date(OPEN_END)).alias(TO), F.col("__next").isNull().alias(CURRENT),
        *[c for c in events.columns if c != key],
    )


def version_history(df: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """Versions per key with the first and last time seen."""
    return df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("versions"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen")
    )


def open_first(dim: DataFrame, on: str) -> DataFrame:
    """Let the first version of every key also cover everything before it.

    Moving its start back to the earliest fact date would give the same matches, but costs a pass over the
    fact. A key has at most one version per day, so the window's group is bounded by the calendar.
    """
    first = F.min(FROM).over(Window.partitionBy(on))
    since = F.when(F.col(FROM) == first, F.lit("0001-01-01").cast("date")).otherwise(F.col(FROM))
    return dim.withColumn("__since", since).drop(FROM).withColumnRenamed("__since", FROM)


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    at: str,
    columns: Sequence[str],
    patch_first: bool = True,
) -> DataFrame:
    """Left join each fact to the version valid on its date; the row count of the fact is preserved.

    Equality on the key drives the hash partitioning and the dates are a residual condition, so AQE splits a
    hot key like in any other equi-join.
    """
    slim = dim.select(on, FROM, TO, *columns)
    side = (open_first(slim, on) if patch_first else slim).select(
        F.col(on).alias("__key"), F.col(FROM).alias("__from"), F.col(TO).alias("__to"), *columns
    )
    day = F.col(at).cast("date")
    hit = splittable([on], ["__key"], ",".join(columns)) & (day >= F.col("__from")) & (day <= F.col("__to"))
    return fact.join(side, hit, "left").drop("__key", "__from", "__to")
