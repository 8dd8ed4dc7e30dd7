"""High-water marks, run records and incremental selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: layouts of the control tables
WATERMARK_SCHEMA = (
    "pipeline_name string, source_table string, watermark_column string, watermark_value timestamp, "
    "batch_id string, rows_processed bigint, rows_inserted bigint, rows_updated bigint, status string, "
    "processed_timestamp timestamp"
)
SILVER_AUDIT_SCHEMA = (
    "pipeline_name string, batch_id string, source_table string, rows_processed bigint, rows_inserted bigint, "
    "rows_updated bigint, start_timestamp timestamp, end_timestamp timestamp, status string"
)
GOLD_AUDIT_SCHEMA = (
    "pipeline_name string, batch_id string, source_table string, target_table string, rows_read bigint, "
    "rows_inserted bigint, rows_expired bigint, start_timestamp timestamp, end_timestamp timestamp, status string"
)


def control_row(spark: SparkSession, schema: str, values: Mapping[str, object]) -> DataFrame:
    """One control record; fields that are not given are null."""
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], schema)


def empty_control(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def last_watermark(control: DataFrame, pipeline: str, how: str = "success") -> DataFrame:
    """One row, ``watermark_value``: null when the pipeline has never run.

    ``how``: ``"success"`` the greatest mark of successful runs, ``"any"`` of all runs,
    ``"latest"`` the mark of the run processed last.
    """
    runs = control.filter(F.col("pipeline_name") == pipeline)
    if how == "latest":
        return runs.agg(F.max_by("watermark_value", "processed_timestamp").alias("watermark_value"))
    if how == "success":
        runs = runs.filter(F.col("status") == "SUCCESS")
    elif how != "any":
        raise ValueError(f"unknown watermark rule {how}")
    return runs.agg(F.max("watermark_value").alias("watermark_value"))


def watermark_of(control: DataFrame, pipeline: str, how: str = "success") -> dt.datetime | None:
    """The mark as a value (one row comes to the driver)."""
    return last_watermark(control, pipeline, how).first()[0]


def incremental(df: DataFrame, column: str, last: dt.datetime | Column | None) -> DataFrame:
    """Rows strictly after the mark; everything when there is none.

    A plain value is pushed down to the scan, where row-group statistics prune old files.
    """
    if last is None:
        return df
    if isinstance(last, Column):
        return df.filter(last.isNull() | (F.col(column) > last))
    return df.filter(F.col(column) > F.lit(last).cast(df.schema[column].dataType))


def next_watermark(df: DataFrame, column: str, last: dt.datetime | None = None) -> DataFrame:
    """One row: the greatest value of the increment, or the old mark for an empty one."""
    return df.agg(F.coalesce(F.max(column), F.lit(last).cast(df.schema[column].dataType)).alias("watermark_value"))


def reset_pipeline(control: DataFrame, pipeline: str, batch_id: str | None = None) -> DataFrame:
    """Control rows without those of a pipeline (or of one of its batches)."""
    gone = F.col("pipeline_name") == pipeline
    if batch_id is not None:
        gone = gone & (F.col("batch_id") == batch_id)
    return control.filter(~F.coalesce(gone, F.lit(False)))


def add_late_rows(df: DataFrame, late: DataFrame, flag: str) -> DataFrame:
    """Union rows that arrived in their own files, marked by ``flag``; absent columns are null."""
    return df.withColumn(flag, F.lit(False)).unionByName(
        late.withColumn(flag, F.lit(True)), allowMissingColumns=True
    )


def reconcile(before: DataFrame, after: DataFrame, amount: str, tolerance_pct: float = 0.0) -> DataFrame:
    """Row counts and sums of two layers side by side, with a variance alert."""
    digest = [F.count(F.lit(1)).alias("row_count"), F.round(F.sum(amount), 2).alias("amount")]
    b = before.agg(*digest).withColumn("side", F.lit("before"))
    a = after.agg(*digest).withColumn("side", F.lit("after"))
    pair = b.unionByName(a).groupBy().agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(m))).alias(f"{side}_{m}")
            for side in ("before", "after") for m in ("row_count", "amount")
        ]
    )
    gap = F.col("after_row_count") - F.col("before_row_count")
    return pair.select(
        "*", gap.alias("row_gap"),
        (F.abs(gap) * 100.0 > F.col("before_row_count") * tolerance_pct).alias("row_alert"),
        (F.col("before_amount") != F.col("after_amount")).alias("amount_alert"),
    )


def touched_history(stored: DataFrame, increment: DataFrame, keys: list[str]) -> DataFrame:
    """The increment plus the stored rows of the keys it touches.

    Sequence numbers and previous values must be computed over this, or they would restart with every batch.
    """
    touched = increment.select(*keys).distinct()
    return increment.unionByName(stored.join(touched, keys, "left_semi"), allowMissingColumns=True)
