"""Table sinks on plain Parquet; published tables (snapshots, bucketed merges) are in :mod:`published`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .published import counted, current_path, current_snapshot, exists, is_published, merge_history, merge_table, publish, vacuum

__all__ = [
    "append", "checklist", "counted", "create_once", "current_path", "current_snapshot", "exists", "is_published", "merge_history", "merge_table",
    "publish", "read_table", "replace_table", "vacuum", "write_bronze",
]


def write_bronze(df: DataFrame, path: str, parts: Sequence[str] = ("year", "month")) -> None:
    """Full overwrite partitioned by period.

    The rebalance hint gathers a period's rows into few files, and AQE splits a large period over many tasks.
    """
    df.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Full replace with the frame's own schema."""
    df.write.mode("overwrite").parquet(path)


def create_once(df: DataFrame, path: str) -> None:
    """One-time load: refuses to run when the table is there."""
    df.write.mode("errorifexists").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A path or a catalog name."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def checklist(spark: SparkSession, expected: Mapping[str, str]) -> DataFrame:
    """Expected tables (name -> path) with presence and row count; empty ones are warned about."""
    rows = []
    for name, path in expected.items():
        there = exists(spark, path)
        rows.append((name, there, spark.read.parquet(path).count() if there else 0))
    out = spark.createDataFrame(rows, "table_name string, present boolean, row_count bigint")
    status = F.when(~F.col("present"), "missing").when(F.col("row_count") == 0, "empty").otherwise("ok")
    return out.withColumn("status", status)
