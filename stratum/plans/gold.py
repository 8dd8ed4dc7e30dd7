"""Publication of the gold layer: dimensions, account history and fact, each with an audit row.

Every table is built once, written to the shared folder, checked and then published as a snapshot. A batch that is already
published is not published again: a run that died in between is repeated with the same batch id and only adds what is
missing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunContext
from ..operators import control
from ..operators.upsert import require_unique
from ..session import released
from ..sources import tables

AUDIT = "gold_audit_log"


@dataclass(frozen=True)
class GoldTable:
    """A published table: ``replace`` it, keep its ``history`` by type 2, or ``upsert`` rows by key."""

    name: str
    source: str
    kind: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...] = ()
    from_col: str = ""
    key_name: str = "dim_key"


Builder = Callable[[Mapping[str, DataFrame]], DataFrame]


def audited(spark: SparkSession, path: str, table: GoldTable, batch_id: str) -> bool:
    if not tables.exists(spark, path):
        return False
    return not tables.read_table(spark, path).filter((F.col("target_table") == table.name) & (F.col("batch_id") == batch_id)).isEmpty()


def publish_table(table: GoldTable, rows: DataFrame, read: int, root: str, ctx: RunContext) -> dict[str, int]:
    """Publish one table from ``read`` rows that are already written; keys must be unique whatever the kind."""
    spark, place = rows.sparkSession, f"{root}/{table.name}"
    if table.kind == "upsert":  # merges check the keys themselves
        counts = tables.merge_table(rows, place, table.keys, ctx.batch_id, written=True)
        return {"rows_inserted": counts["inserted"], "rows_expired": 0}
    if table.kind == "replace":
        require_unique(rows, table.keys)
        tables.publish(rows, place, ctx.batch_id)
        return {"rows_inserted": read, "rows_expired": 0}
    [key] = table.keys
    counts = tables.merge_history(rows, place, key, table.tracked, table.from_col, ctx.as_of, ctx.batch_id, table.key_name, written=True)
    return {"rows_inserted": counts["inserted"], "rows_expired": counts["expired"]}


def run_gold(
    spark: SparkSession, plan: Sequence[tuple[GoldTable, Builder]], root: str, control_root: str, ctx: RunContext, pipeline: str = "gold"
) -> dict[str, dict[str, int]]:
    """Build and publish the tables in order; a builder gets the tables published so far by name."""
    log, done, ready = f"{control_root}/{AUDIT}", {}, {}
    for table, build in plan:
        place = f"{root}/{table.name}"
        start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        if not audited(spark, log, table, ctx.batch_id):
            facts = {"rows_read": None, "rows_inserted": None, "rows_expired": None}
            if not tables.is_published(spark, place, ctx.batch_id):
                with released(spark):
                    rows, read = tables.counted(build(ready), table.name)
                    facts = {"rows_read": read, **publish_table(table, rows, read, root, ctx)}
            end = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            row = {
                "pipeline_name": pipeline, "batch_id": ctx.batch_id, "source_table": table.source, "target_table": table.name,
                "start_timestamp": start, "end_timestamp": end, "status": "SUCCESS", **facts,
            }
            tables.append(control.control_row(spark, control.GOLD_AUDIT_SCHEMA, row), log)
            done[table.name] = facts
        ready[table.name] = tables.current_snapshot(spark, place)
    return done
