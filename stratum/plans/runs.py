"""One incremental run of a silver entity: increment, build, merge, record."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RunContext
from ..operators import control
from ..session import durable, released
from ..sources import tables

WATERMARK, AUDIT = "batch_watermark", "silver_audit_log"


def _log(spark, path: str, schema: str) -> DataFrame:
    return tables.read_table(spark, path) if tables.exists(spark, path) else control.empty_control(spark, schema)


def affected(history: DataFrame, increment: DataFrame, keys: Sequence[str], group: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(bronze rows to build from, groups to publish) when built columns depend on a whole group.

    Groups are those that a touched key is in or was in before; all members of these groups are built from all their
    rows, so counts, sequences and deltas come out as in a full load. Members that have moved elsewhere since are built
    too, but their new groups are not published.
    """
    arrived = increment.select(*[F.col(k).alias(f"__i_{k}") for k in keys]).distinct()
    same = lambda names, mark: [F.col(n).eqNullSafe(F.col(f"{mark}{n}")) for n in names]
    touched = history.join(arrived, same(keys, "__i_"), "left_semi").select(*[F.col(g).alias(f"__t_{g}") for g in group]).distinct()
    touched = durable(touched, "groups")
    members = history.join(touched, same(group, "__t_"), "left_semi").select(*[F.col(k).alias(f"__m_{k}") for k in keys]).distinct()
    return history.join(members, same(keys, "__m_"), "left_semi"), touched


def run_silver(
    pipeline: str,
    bronze: DataFrame,
    build: Callable[[DataFrame, RunContext], DataFrame],
    root: str,
    keys: Sequence[str],
    control_root: str,
    ctx: RunContext,
    preserve: Sequence[str] = ("created_timestamp",),
    watermark: str = "_ingest_timestamp",
    rule: str = "success",
    group: Sequence[str] = (),
) -> Mapping[str, int]:
    """Process what arrived after the last mark and publish the merged table at ``root``.

    ``build`` gets the new rows; other inputs it needs are bound by the caller. Where built columns depend on more than
    the row (counts per customer, positions and deltas per account), ``group`` names the columns, and ``build`` gets all
    rows of the groups that the new ones touch; rows already stored are corrected by the merge.

    An empty increment ends the run without a trace. The mark and the audit row are written after the table is
    published: a run that dies in between is repeated, with a new batch id or the same one, and gives the same table.
    """
    spark = bronze.sparkSession
    start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    marks, audits = f"{control_root}/{WATERMARK}", f"{control_root}/{AUDIT}"
    last = control.watermark_of(_log(spark, marks, control.WATERMARK_SCHEMA), pipeline, rule)
    increment = control.incremental(bronze, watermark, last)
    # the one pass over the increment beside the build, on the mark's column alone
    found = increment.agg(F.count(F.lit(1)).alias("n"), F.max(watermark).alias("mark")).first()
    if not found["n"]:
        return {"processed": 0, "inserted": 0, "updated": 0}
    # an upper bound as well, so that rows arriving during the run wait for the next one
    increment = increment.filter(F.col(watermark) <= F.lit(found["mark"]))
    touch: dict[str, Column] = {"updated_timestamp": F.current_timestamp(), "silver_load_timestamp": F.current_timestamp()}
    if tables.is_published(spark, root, ctx.batch_id):  # the run died between publication and mark
        counts = {"inserted": None, "updated": None}
    else:
        with released(spark):
            if group:
                upto = bronze.filter(F.col(watermark) <= F.lit(found["mark"]))
                source, touched = affected(upto, increment, keys, group)
                built = build(source, ctx)
                built = built.join(touched, [F.col(g).eqNullSafe(F.col(f"__t_{g}")) for g in group], "left_semi")
            else:
                built = build(increment, ctx)
            kept = [c for c in preserve if c in built.columns]
            counts = tables.merge_table(built, root, keys, ctx.batch_id, kept, {c: v for c, v in touch.items() if c in built.columns})
    facts = {
        "pipeline_name": pipeline, "source_table": pipeline, "watermark_column": watermark, "watermark_value": found["mark"],
        "batch_id": ctx.batch_id, "rows_processed": found["n"], "rows_inserted": counts["inserted"],
        "rows_updated": counts["updated"], "status": "SUCCESS", "start_timestamp": start,
        "processed_timestamp": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
    }
    facts["end_timestamp"] = facts["processed_timestamp"]
    tables.append(control.control_row(spark, control.WATERMARK_SCHEMA, facts), marks)
    tables.append(control.control_row(spark, control.SILVER_AUDIT_SCHEMA, facts), audits)
    return {"processed": found["n"], "inserted": counts["inserted"], "updated": counts["updated"]}
