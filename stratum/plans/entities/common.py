"""Shared pieces of the silver builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...config import RunContext

BRONZE_META = ("_source_file", "_ingest_timestamp", "_batch_id", "_commit_sha", "year", "month")
# fixed values: date formats, day first wins over month first
EVENT_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")


def today(ctx: RunContext) -> Column:
    return F.lit(ctx.as_of.isoformat()).cast("date")


def kinds(text: str = "", lower: str = "", upper: str = "", plain: str = "", **typed: str) -> dict[str, str]:
    """A column spec from blank-separated name lists per kind."""
    groups = {"string trim": text, "string lower trim": lower, "string upper trim": upper, "string": plain}
    groups.update({k.rstrip("_"): v for k, v in typed.items()})
    return {name: kind for kind, names in groups.items() for name in names.split()}


def silver_meta(df: DataFrame, source: str, ctx: RunContext) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({
        "record_source": F.lit(source), "created_timestamp": now, "updated_timestamp": now,
        "is_current": F.lit(True), "silver_batch_id": F.lit(ctx.batch_id), "silver_load_timestamp": now,
    })


