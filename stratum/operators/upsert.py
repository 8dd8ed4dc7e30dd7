"""Keyed upsert as a snapshot: the new table is a DataFrame, published by the table sink.

One full outer join reads each side once. Rows with a null in the key never match (SQL equality); a row
hash in the join key spreads them over the partitions instead of piling them up in one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: What became of a row in a merge.
STATE = "__merge_state"
#: Parts into which the rows of one place are dealt.
SLOTS = 64


def null_spread(keys: Sequence[str], columns: Sequence[str], side: int) -> Column:
    """0 for complete keys, a side-specific row hash for keys with a null."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.xxhash64(F.lit(side), *[F.col(f"`{c}`") for c in columns])).otherwise(F.lit(0).cast("bigint"))


def _paired(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = target.select(
        F.struct(*target.columns).alias("t"), *[F.col(k).alias(f"__t_{k}") for k in keys],
        null_spread(keys, target.columns, 0).alias("__tn"),
    )
    s = source.select(
        F.struct(*source.columns).alias("s"), *[F.col(k).alias(f"__s_{k}") for k in keys],
        null_spread(keys, source.columns, 1).alias("__sn"),
    )
    on = reduce(lambda a, b: a & b, [F.col(f"__t_{k}") == F.col(f"__s_{k}") for k in keys])
    return t.join(s, on & (F.col("__tn") == F.col("__sn")), "full_outer").select("t", "s")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    preserve: Sequence[str] = (),
    touch: Mapping[str, Column] | None = None,
    state: str | None = None,
) -> DataFrame:
    """The table after merging ``source`` into ``target``.

    A matched row takes every source column except ``preserve`` (for instance the creation time), and the
    ``touch`` columns take their expressions. Unmatched source rows are inserted as they are, unmatched
    target rows stay. Source keys must be unique: check with :func:`repeated_keys` first. ``state`` names a column that
    tells ``inserted``, ``updated`` and ``untouched`` rows apart.
    """
    return _merged(_paired(target, source, keys), target, source, preserve, touch, state)


def _merged(
    pairs: DataFrame, target: DataFrame, source: DataFrame, preserve: Sequence[str], touch: Mapping[str, Column] | None, state: str | None,
    also: Sequence[str] = (),
) -> DataFrame:
    """The merged rows of ``pairs`` (target row ``t``, source row ``s``), with the columns ``also`` of the pairs as they are."""
    touch = touch or {}
    have_t, have_s = set(target.columns), set(source.columns)
    matched = F.col("s").isNotNull() & F.col("t").isNotNull()
    out = []
    for name in [*target.columns, *[c for c in source.columns if c not in have_t]]:
        old = F.col(f"t.`{name}`") if name in have_t else F.lit(None)
        new = F.col(f"s.`{name}`") if name in have_s else F.lit(None)
        updated = touch.get(name, old if name in preserve or name not in have_s else new)
        value = F.when(matched, updated).when(F.col("s").isNotNull(), new).otherwise(old)
        out.append(value.alias(name))
    if state:
        kind = F.when(matched, "updated").when(F.col("s").isNotNull(), "inserted").otherwise("untouched")
        out.append(kind.alias(state))
    return pairs.select(*out, *also)


def upsert_placed(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    place: str,
    preserve: Sequence[str] = (),
    touch: Mapping[str, Column] | None = None,
    state: str | None = None,
) -> DataFrame:
    """:func:`upsert` of frames whose column ``place`` follows from the key, with the rows dealt by place for the write.

    A join deals rows by the whole key, and a write by place would shuffle and sort them again. Here both sides go once to
    ``SLOTS`` parts of their place, and a row meets its key's others there.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])

    def side(df: DataFrame, number: int) -> DataFrame:
        columns = [c for c in df.columns if c != place]
        spread = null_spread(keys, df.columns, number)
        return df.select(
            F.col(place), F.pmod(F.xxhash64(*[F.col(k) for k in keys], spread, F.lit("slot")), F.lit(SLOTS)).cast("int").alias("__slot"),
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.when(missing, F.lit(number)).otherwise(-1).alias("__side"),
            spread.alias("__spread"), F.struct(*columns).alias("ts"[number]),
        )

    t, s = side(target, 0), side(source, 1)
    rows = t.unionByName(s, allowMissingColumns=True).repartition(place, "__slot")
    # nulls match nothing: sides with a null in the key do not meet
    one = Window.partitionBy(place, "__slot", *[f"__k{i}" for i in range(len(keys))], "__side", "__spread")
    met = rows.withColumns({"__s": F.first("s", ignorenulls=True).over(one), "__t": F.count("t").over(one)})
    pairs = met.filter(F.col("t").isNotNull() | (F.col("__t") == 0)).select(place, "t", F.col("__s").alias("s"))
    return _merged(pairs, target.drop(place), source.drop(place), preserve, touch, state, [place])


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the true numbers of inserted, updated and untouched rows."""
    t = target.select(*keys)
    pairs = _paired(t, source.select(*keys), keys)
    return pairs.agg(
        F.count_if(F.col("t").isNull()).alias("inserted"),
        F.count_if(F.col("t").isNotNull() & F.col("s").isNotNull()).alias("updated"),
        F.count_if(F.col("s").isNull()).alias("untouched"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys that occur more than once, with their count."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail when a key repeats; otherwise hand the frame through."""
    bad = repeated_keys(df, keys).take(3)
    if bad:
        raise ValueError(f"keys {list(keys)} are not unique, for example {[r.asDict() for r in bad]}")
    return df


def backfill(df: DataFrame, column: str, default: object) -> DataFrame:
    """Add ``column`` if absent and replace its nulls by ``default``."""
    value = F.coalesce(F.col(column), F.lit(default)) if column in df.columns else F.lit(default)
    return df.withColumn(column, value)
