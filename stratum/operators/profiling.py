"""Profiles: frequencies, histograms, null and cardinality profiles, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..session import durable
from .groups import with_group_count


def frequency(df: DataFrame, keys: Sequence[str | Column], top_n: int | None = None) -> DataFrame:
    """Counts per value, most frequent first; ``top_n`` turns it into a top-k report."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    ordered = out.orderBy(F.desc("row_count"), *[c for c in out.columns if c != "row_count"])
    return ordered if top_n is None else ordered.limit(top_n)


def profile_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count) for several columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def count_histogram(df: DataFrame, key: Sequence[str], size_name: str = "group_size") -> DataFrame:
    """How many keys have 1, 2, 3 ... rows."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias(size_name))
    return sizes.groupBy(size_name).agg(F.count(F.lit(1)).alias("key_count"))


def cross_tab(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Counts of two keys, the second one spread over columns."""
    return df.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()],
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage of every column, one pass for the table."""
    names = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(f"__{i}") for i, c in enumerate(names)])
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), (F.col("__rows") - F.col(f"__{i}")).alias("nulls"),
            F.try_divide((F.col("__rows") - F.col(f"__{i}")) * 100.0, F.col("__rows")).alias("null_pct"),
        )
        for i, c in enumerate(names)
    ])
    return one.select(F.inline(lines))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct and null counts of every column.

    Each column is an aggregate of its own: values are hashed in their own type and combined map-side, then counted. A
    columnar scan reads one column per aggregate, together the table once; no row per cell is ever made. Give a stored
    table (``session.durable`` of a costly plan).
    """
    lines = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        value = F.to_json(name) if isinstance(kind, MapType) else F.col(name)
        counted = df.select(value.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        lines.append(counted.agg(
            F.count("value").alias("distinct_values"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        ).select(F.lit(name).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, lines)


def candidate_keys(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """For each column set: distinct combinations (nulls count as values) and whether they identify a row."""
    one = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_distinct(F.struct(*ks)).alias(f"__{i}") for i, ks in enumerate(key_sets)],
    )
    lines = F.array(*[
        F.struct(
            F.lit(",".join(ks)).alias("key_columns"), F.col(f"__{i}").alias("distinct_keys"),
            F.col("__rows").alias("row_count"), (F.col(f"__{i}") == F.col("__rows")).alias("is_key"),
        )
        for i, ks in enumerate(key_sets)
    ])
    return one.select(F.inline(lines))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def duplicate_rows(df: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """All rows of the keys that occur more than once, with their ``copies``."""
    return with_group_count(df, keys, "copies", null_safe=null_safe).filter("copies > 1")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max per column as rows."""
    return df.select(*columns).describe()


def month_counts(df: DataFrame, date: str, name: str) -> DataFrame:
    """Rows per year and month of one table; rows without a date are left to the null profile."""
    day = F.col(date)
    return (
        df.filter(day.isNotNull()).groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
    )


def coverage(tables: Mapping[str, tuple[DataFrame, str]], full_year: int = 12) -> DataFrame:
    """Rows and months present per table and year; ``is_complete`` marks years with all months."""
    parts = [month_counts(df, date, name) for name, (df, date) in tables.items()]
    months = reduce(lambda a, b: a.unionByName(b), parts)
    return months.groupBy("table_name", "year").agg(
        F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("months"),
        (F.count(F.lit(1)) >= full_year).alias("is_complete"),
    )


def coverage_grid(df: DataFrame, date: str, name: str) -> DataFrame:
    """One row per year, one mark per month: ``x`` present, ``.`` missing."""
    months = month_counts(df, date, name)
    grid = months.groupBy("table_name", "year").pivot("month", list(range(1, 13))).agg(F.first("row_count"))
    return grid.select(
        "table_name", "year",
        *[F.when(F.col(f"`{m}`") > 0, "x").otherwise(".").alias(f"m{m:02d}") for m in range(1, 13)],
    )


def flag_incomplete_years(df: DataFrame, date: str, full_year: int = 12) -> DataFrame:
    """Add ``data_quality_flag``: ``incomplete_year`` on rows of years with missing months."""
    # a row per year: written, so that Spark knows how small it is and leaves the table where it is
    years = durable(coverage({"t": (df, date)}, full_year).select(F.col("year").alias("__y"), "is_complete"), "years")
    flag = F.when(F.col("is_complete"), "complete").when(F.col("is_complete").isNull(), "undated")
    return (
        df.join(years, F.year(date) == F.col("__y"), "left")
        .withColumn("data_quality_flag", flag.otherwise("incomplete_year")).drop("__y", "is_complete")
    )
