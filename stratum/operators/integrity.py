"""Referential integrity: orphan flags and orphan rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .groups import splittable


def distinct_keys(dim: DataFrame, names: Sequence[Column | str], aliases: Sequence[str]) -> DataFrame:
    """The non-null keys of a dimension, once each."""
    cols = [F.col(n) if isinstance(n, str) else n for n in names]
    return dim.select(*[c.alias(a) for c, a in zip(cols, aliases)]).na.drop().distinct()


def key_union(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct keys known to any of several tables."""
    out = sources[0].select(key)
    for df in sources[1:]:
        out = out.unionByName(df.select(key))
    return out.na.drop().distinct()


def existence_flag(df: DataFrame, dim: DataFrame, on: Mapping[str, str], name: str) -> DataFrame:
    """Add ``name`` = True where no dimension row has the key (a null key is an orphan).

    Keys are made distinct first, so a dimension that repeats keys cannot multiply rows.
    """
    aliases = [f"__d{i}" for i in range(len(on))]
    known = distinct_keys(dim, list(on.values()), aliases).withColumn("__known", F.lit(True))
    joined = df.join(known, splittable(list(on), aliases, name), "left")
    return joined.withColumn(name, F.col("__known").isNull()).drop("__known", *aliases)


def orphans(df: DataFrame, dim: DataFrame, on: Mapping[str, str | Column]) -> DataFrame:
    """Rows whose key is missing from ``dim`` (keys may be named or cleaned differently there)."""
    aliases = [f"__d{i}" for i in range(len(on))]
    cols = [F.col(v) if isinstance(v, str) else v for v in on.values()]
    keys = dim.select(*[c.alias(a) for c, a in zip(cols, aliases)])
    return df.join(keys, splittable(list(on), aliases, "missing"), "left_anti")


def orphans_everywhere(df: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Rows missing from every dimension."""
    for dim, on in dims:
        df = orphans(df, dim, on)
    return df


def found_elsewhere(df: DataFrame, first: tuple, second: tuple) -> DataFrame:
    """Rows missing from the first dimension but present in the second."""
    missing = orphans(df, *first)
    dim, on = second
    aliases = [f"__d{i}" for i in range(len(on))]
    keys = dim.select(*[F.col(v).alias(a) for v, a in zip(on.values(), aliases)])
    return missing.join(keys, splittable(list(on), aliases, "found"), "left_semi")


def rows_of_sample(df: DataFrame, key: str, sample: DataFrame) -> DataFrame:
    """All rows of the keys in a (small) sample frame, without collecting the keys."""
    return df.join(sample.select(F.col(key).alias("__s")), F.col(key) == F.col("__s"), "left_semi")


def split_by(df: DataFrame, column: str, parts: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Named sub-frames by value of ``column``."""
    return {name: df.filter(F.col(column).isin(list(values))) for name, values in parts.items()}
